"""Training-data operators over text tables (documents, pages, conversations).

Nothing else in the library imports this package; it may be deleted whole.
"""
