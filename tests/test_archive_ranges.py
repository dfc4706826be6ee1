"""Archives by byte ranges and members by blocks: the same rows as reading them whole."""

import csv
import io
import random
import struct
import zipfile

import pyarrow as pa
import pytest

from shelfline.sources import archive_ranges as R
from shelfline.sources import archives as A
from shelfline.sources import csv_ranges as C

HEAD = "a,b,c,d,e,f,g\n"


def quoted_text(rnd, n):
    return "".join(rnd.choice(['"', '"', ",", ";", "x", "y z", "\n", "\n", "\r\n", "\r", "é", " ", "\x85", '""', '",', ',"']) for _ in range(n))


def whole(text, delimiter):
    csv.field_size_limit(1 << 40)
    return list(csv.reader(list(A._lines(text)), delimiter=delimiter))


def by_blocks(texts, delimiter):
    """What ``split_records`` does, in one process."""
    lines = [list(A._lines(t)) for t in texts]
    told = [(*C.summary(x, delimiter, 0), *C.summary(x, delimiter, 1)) for x in lines]
    done, parts = {}, {}
    for x, (before, first) in zip(lines, C.place(told), strict=True):
        for number, fields, part in C.tokenise(x, delimiter, before, first):
            if part is None:
                assert number not in done
                done[number] = fields
            else:
                parts.setdefault(number, []).extend(part)
    for number, part in parts.items():
        assert number not in done
        (done[number],) = csv.reader(part, delimiter=delimiter)
    assert sorted(done) == list(range(len(done)))
    return [done[i] for i in range(len(done))]


def cuts(text, size):
    """Blocks as the inflater cuts them: ``size`` bytes or more, behind a line end."""
    data, out, held = text.encode(), [], b""
    for i in range(0, len(data), size):
        held += data[i: i + size]
        at = R.last_line_end(held)
        if at:
            out.append(held[:at].decode())
            held = held[at:]
    return [*out, held.decode()] if held else out


def test_records_are_those_of_the_csv_reader_for_every_block_size():
    rnd = random.Random(4)
    for case in range(150):
        text = quoted_text(rnd, rnd.randint(0, 60))
        for delimiter in ",;":
            want = whole(text, delimiter)
            for size in [*range(1, 12), 30, 1000]:
                assert by_blocks(cuts(text, size), delimiter) == want, (text, size)


def member(rnd, lines):
    rows = io.StringIO()
    w = csv.writer(rows, delimiter=rnd.choice(",;"), lineterminator=rnd.choice(["\n", "\r\n"]))
    w.writerow(list("abcdefg"))
    for i in range(lines):
        w.writerow([rnd.choice(["x", 'q"u', "multi\nline", "a,b;c", "", "é" * 5, str(i)]) for _ in range(rnd.choice([7, 7, 7, 5, 9]))])
    return rows.getvalue().encode()


def archive(rnd, method, members=8, lines=40, extra=()):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", method) as zf:
        for i in range(members):
            zf.writestr(f"Компания {i}_{i}.csv" if i % 2 else f"Shop_{i}.CSV", member(rnd, lines))
            if i % 3 == 0:
                zf.writestr(f"note{i}.txt", "not csv " * 50)
        for name, content in extra:
            zf.writestr(name, content)
        zf.comment = b"made for a test"
    return data.getvalue()


def odd_archives():
    rnd = random.Random(9)
    odd = [("empty_1.csv", b""), ("mark_2.csv", b"\xef\xbb\xbf"), ("head_3.csv", HEAD.encode()), ("latin_4.csv", "é,ö\n".encode("latin-1") * 400),
           ("open_5.csv", (HEAD + 'x,"y\n' + "z,1,2\n" * 300).encode()), ("marked_6.csv", b"\xef\xbb\xbf" + (HEAD + "1,2,3,4,5,6,7\r\n" * 99).encode()),
           ("cr_7.csv", HEAD.replace("\n", "\r").encode() + b"1,2,3,4,5,6,7\r" * 200), ("long_8.csv", HEAD.encode() + b"x" * 5000 + b",1\n"),
           ("nolast_9.csv", (HEAD + "1,2,3,4,5,6,7\n2").encode()), ("zero_10.csv", b"a,b\0c\n\n\n1\n"), ("folder/x_11.csv", HEAD.encode())]
    good = {"2026-01-01": archive(rnd, zipfile.ZIP_DEFLATED, extra=odd), "2026-01-02": archive(rnd, zipfile.ZIP_STORED, 5),
            "2026-01-03": archive(rnd, zipfile.ZIP_BZIP2, 3), "2026-01-04": archive(rnd, zipfile.ZIP_LZMA, 3),
            "2026-01-05": b"some bytes before it" + archive(rnd, zipfile.ZIP_DEFLATED, 2),
            "2026-01-06": archive(rnd, zipfile.ZIP_DEFLATED, 0), "2026-01-07": archive(rnd, zipfile.ZIP_DEFLATED, 1, 6000)}
    first = bytearray(good["2026-01-01"])
    first[len(first) // 3] ^= 0xFF  # inside some member
    stored = bytearray(good["2026-01-02"])
    stored[stored.index(b"not csv") + 2] ^= 1  # in a member that is not even CSV
    header = bytearray(good["2026-01-03"])
    header[30] ^= 1  # a local header's name
    locked = bytearray(good["2026-01-03"])
    at = locked.index(b"PK\1\2") + 8
    locked[at: at + 2] = struct.pack("<H", struct.unpack("<H", locked[at: at + 2])[0] | 1)
    bad = {"2026-02-01": bytes(first), "2026-02-02": bytes(stored), "2026-02-03": bytes(header), "2026-02-04": good["2026-01-01"][:-300],
           "2026-02-05": b"no archive at all\n" * 40, "2026-02-06": b"", "2026-02-07": bytes(locked)}
    return good | bad


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("zips")
    for date, data in odd_archives().items():
        (base / f"{date}.zip").write_bytes(data)
    return str(base)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def read_whole(spark, folder):
    return rows_of(A.scan_archives(spark, folder))


@pytest.mark.parametrize("sizes", [{}, {"piece_bytes": 700, "tail_bytes": 300, "group_bytes": 900, "block_bytes": 256}])
def test_ranges_give_the_rows_of_whole_archives(spark, folder, read_whole, sizes):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000" if sizes else before)  # several splits a file
    try:
        got = rows_of(A.scan_archives(spark, folder, whole_bytes=0, **sizes))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r[1]: r[5] for r in read_whole if r[0] == "archive"} == {
        d: "ok" if d < "2026-02" else "corrupt" for d, data in odd_archives().items() if data}  # an empty file isn't listed
    assert got == read_whole


def test_pieces_are_the_files_bytes(spark, folder):
    from pyspark.sql import functions as F

    paths = [r.path for r in A.list_archives(spark, folder).collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = R.file_pieces(spark, paths, 333).withColumn("date", A.archive_date(F.col("path"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for date in odd_archives():
        with open(f"{folder}/{date}.zip", "rb") as f:  # (made anew, an archive has other times in it)
            data = f.read()
        mine = sorted((r["at"], bytes(r["data"])) for r in rows if r["date"] == date)
        assert b"".join(d for _, d in mine) == data
        assert all(at == sum(len(d) for _, d in mine[:i]) for i, (at, _) in enumerate(mine))
        assert all(len(d) < 1400 for _, d in mine)


def test_a_large_member_is_many_tasks_of_bounded_blocks(spark, tmp_path):
    rnd = random.Random(1)
    data = archive(rnd, zipfile.ZIP_DEFLATED, 1, 20_000)
    (tmp_path / "2026-03-01.zip").write_bytes(data)
    path = [f"{tmp_path}/2026-03-01.zip"]
    pieces = R.file_pieces(spark, path)
    blocks = R.member_blocks(pieces, R.directories(pieces), block_bytes=8192).filter("kind = 'block'").collect()
    assert len(blocks) > 20
    assert max(len(b.content) for b in blocks) < 8192 + R._STEP
    assert rows_of(A.scan_archives(spark, path, whole_bytes=0, block_bytes=8192)) == rows_of(A.scan_archives(spark, path))


def test_scan_queries_pack_the_archives_once(spark, monkeypatch):
    from shelfline.plans import catalog_store as S

    packed, write = [], S.write_once
    monkeypatch.setattr(S, "write_once", lambda df: packed.append(df) or write(df))
    plan = S._scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(packed) == 1 and "collect_list" not in plan


def test_many_small_files_share_tasks_and_batches(spark, tmp_path, monkeypatch):
    """What grows with the number of files is not one task, batch or call for every few of them."""
    for i in range(60):
        (tmp_path / f"{i}.zip").write_bytes(archive(random.Random(i), zipfile.ZIP_DEFLATED, members=2, lines=3))
    tasks, write = [], R.write_once
    monkeypatch.setattr(R, "write_once", lambda df, *a: tasks.append(df.rdd.getNumPartitions()) or write(df, *a))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(8 << 20))
    try:
        R.file_pieces(spark, [str(tmp_path)], name_filter="*.zip")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks[0] <= 8
    batches = list(R._gathered(((i, b"x") for i in range(2500)), {"n": pa.int64(), "data": pa.binary()}))
    assert [b.num_rows for b in batches] == [1000, 1000, 500]
    assert rows_of(A.scan_archives(spark, str(tmp_path), whole_bytes=0)) == rows_of(A.scan_archives(spark, str(tmp_path)))


def test_lines_of_the_made_archives_are_those_of_a_csv_writer(spark):
    from shelfline.plans import catalog_store as S
    from shelfline.schemas import RAW_COLUMNS

    rnd = random.Random(7)
    rows = [(rnd.choice(",;"), rnd.choice([6, 7]), *[rnd.choice(["", None, "x", ' "q" ', "a,b", "c;d", "l\nm", "r\rs", '"', "é"]) for _ in RAW_COLUMNS])
            for _ in range(60)]
    df = spark.createDataFrame(rows, "delimiter string, n_fields int, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)).coalesce(1)
    for row, line in zip(rows, df.select(S._csv_line().alias("line")).collect(), strict=True):
        text = io.StringIO()
        csv.writer(text, delimiter=row[0], lineterminator="\n").writerow([x or "" for x in row[2: 2 + row[1]]])
        assert line["line"] == text.getvalue()


def test_lines_at_once_are_those_of_the_stream():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["x", "\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u2028", "\u2029", '"']) for _ in range(12))
        assert C._text_lines(text) == list(A._lines(text))


def test_batches_of_records_hold_the_rows_of_their_blocks(monkeypatch):
    rows = [{"zip_date": "d", "source": "s", "file_seq": i, "file_name": f"{i}.csv", "delimiter": ",", "block": 0, "before": 0, "first": 0,
             "content": ("a,b\n" * n).encode()} for i, n in enumerate([3, 0, 5, 1])]
    monkeypatch.setattr(C, "_BATCH", 2)
    found = [r for b in C._records(iter([pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])])) for r in b.to_pylist()]
    assert [(r["file_seq"], r["file_name"], r["number"]) for r in found] == [(i, f"{i}.csv", k) for i, n in enumerate([3, 0, 5, 1]) for k in range(n)]
    assert all(r["fields"] == ["a", "b"] and r["n_fields"] == 2 and r["lines"] is None for r in found)
