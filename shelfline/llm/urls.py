"""URL filters: host rules, then naive Bayes over segmented names.

Rules decide the urls they fit.  For the others, host and path are split at
punctuation, each run of letters is segmented into words by Viterbi decoding
of a unigram model, and a multinomial naive Bayes model scores the words.

Learned from the pages themselves, over all rows: word counts of the visible
html (unigrams), and url word counts per label (naive Bayes).  A page's label
is weak: "block" where its visible text is junk (symbol runs, shouting, tables
of bars) or its host has one of ``SEED_WORDS``, else "allow".

Both models are tables of any size, and no word is cut from them: a run of
letters meets the counts of its own substrings by a join and is segmented once,
however many urls hold it, and its score is the sum of its words' weights.  The
driver sees totals only.  Weights are whole billionths, so that a score does
not depend on the order of its sum.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule and no words (the prior decides); null html has no words and no label;
repeated rows and ids are judged alike, row by row; a long run of letters is
segmented whole; empty tables give empty results; input columns named like a
result column give way to it, others stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from shelfline.llm import store

# The rules (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Words that mark unwanted hosts.
SEED_WORDS = ("adult", "bet", "bets", "casino", "cheap", "escort", "farm", "gambling", "loan", "pills", "poker",
              "porn", "sex", "slots", "spam", "track", "viagra", "win", "xxx")
SEED_SHARE = 5e-5  # of all words, added to their word counts, so that they can be told apart in a name
_SEED_SET = frozenset(SEED_WORDS)
LONGEST_WORD = 24
UNIT = 10 ** 9  # a weight of 1
_FLUSH = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = re.compile(r"[^\W\d_]+")
# Words of running text: not parts of dotted names, which hosts are.
_PLAIN_WORD = re.compile(r"(?<![\w.])[^\W\d_]+(?!\w|\.\w)")
_TAGS = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.DOTALL | re.IGNORECASE)
_SYMBOL_WORD = re.compile(r"[#$%&*]{3}|&amp;&amp;&amp;")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def visible(html: str) -> str:
    """Text of a page without tags, scripts and styles."""
    return _TAGS.sub(" ", html)


def looks_bad(text: str) -> bool:
    """Weak label of a page: a tenth of its words are symbol runs, shouts or bars."""
    words = text.split()
    bad = sum(1 for w in words if w == "|" or w.endswith("!!") or _SYMBOL_WORD.search(w))
    return bool(words) and bad * 10 >= len(words)


def viterbi(run: str, score: dict[str, float], unknown: float) -> list[str]:
    """The likeliest words of a run; an unknown word costs more the longer it is."""
    best, cut = [0.0], [0]
    for end in range(1, len(run) + 1):
        top, at = -math.inf, end - 1
        for start in range(max(0, end - LONGEST_WORD), end):
            word = run[start:end]
            here = best[start] + score.get(word, unknown * len(word))
            if here > top:
                top, at = here, start
        best.append(top)
        cut.append(at)
    words, end = [], len(run)
    while end:
        words.append(run[cut[end]: end])
        end = cut[end]
    return words[::-1]


class Segmenter:
    """Splits a run of letters into its likeliest words.

    Only shares of the total count, so a larger corpus splits alike.  A seed
    word in ``counts`` is likelier than the best split of it into other words.
    ``total`` and ``least`` are those of the corpus where ``counts`` is a part.
    """

    def __init__(self, counts: dict[str, float], total: float | None = None, least: float | None = None):
        self.total = total or sum(counts.values()) or 1
        self.score = {w: math.log(n / self.total) for w, n in counts.items() if len(w) <= LONGEST_WORD}
        # Less likely than the rarest word.
        self.unknown = math.log((least or min(counts.values(), default=1)) / self.total) - 2.0
        for seed in sorted(_SEED_SET & self.score.keys(), key=lambda w: (len(w), w)):
            own = self.score.pop(seed)
            parts = sum(self.score.get(w, self.unknown * len(w)) for w in self(seed))
            self.score[seed] = max(own, parts + 1e-9)  # (more than sums of logarithms are off)

    def __call__(self, run: str) -> list[str]:
        return viterbi(run, self.score, self.unknown)


def substrings(run: str) -> Iterator[set[str]]:
    """All parts of a run that may be words, a stretch of the run at a time."""
    for at in range(0, len(run), 2048):
        yield {run[i:j] for i in range(at, min(at + 2048, len(run))) for j in range(i + 1, min(i + LONGEST_WORD, len(run)) + 1)}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of running text, summed up per task and written out when they grow large."""
    held: Counter = Counter()
    for batch in batches:
        for rows in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
            for html in rows.column(0).to_pylist():
                held.update(w for w in _PLAIN_WORD.findall(visible(html or "").lower()) if len(w) <= LONGEST_WORD)
            if len(held) > _FLUSH:
                yield _counted(held)
                held.clear()
    yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                      names=["word", "n"])


@dataclass
class Lexicon:
    """Word counts as a table (word, n) and what all tasks need of it."""

    words: DataFrame
    total: float
    least: float
    seeds: dict[str, float]  # scores of the seed words


def lexicon(pages: DataFrame, html: str = "html") -> Lexicon:
    """The words of all pages with their counts; seed words get a share of all words besides."""
    store.prepare(pages.sparkSession)
    words = store.materialise(pages.select(F.col(html)).mapInArrow(_word_counts, "word string, n long")
                              .groupBy("word").agg(F.sum("n").alias("n")))
    parts = {p for w in SEED_WORDS for s in substrings(w) for p in s}
    known = {r["word"]: r["n"] for r in words.filter(F.col("word").isin(sorted(parts))).collect()}
    found = words.agg(F.sum("n"), F.min(F.when(~F.col("word").isin(*SEED_WORDS), F.col("n")))).first()
    share = SEED_SHARE * (found[0] or 1)
    known |= {w: known.get(w, 0) + share for w in SEED_WORDS}
    total = (found[0] or 0) + share * len(SEED_WORDS)
    least = min([known[w] for w in SEED_WORDS] + [found[1]] * (found[1] is not None))
    score = Segmenter(known, total, least).score
    return Lexicon(words, total, least, {w: score[w] for w in SEED_WORDS})


def segmented(runs: DataFrame, lex: Lexicon) -> DataFrame:
    """(run, words) of distinct runs of letters, written; each meets the counts of its own substrings."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for some in substrings(run):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(some), pa.int64()), pa.array(list(some), pa.string())], names=["__run", "word"])

    total, seeds = lex.total, lex.seeds
    unknown = math.log(lex.least / total) - 2.0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for run, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.append(viterbi(run, {k["word"]: math.log(k["n"] / total) for k in known or []} | seeds, unknown))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    numbered = store.with_row_key(runs.select("run").distinct(), "__run")
    own = numbered.mapInArrow(parts, "__run long, word string").join(lex.words, "word").groupBy("__run").agg(
        F.collect_set(F.struct("word", "n")).alias("known"))
    return store.materialise(numbered.join(own, "__run", "left").select("run", "known").mapInArrow(
        split, "run string, words array<string>"))


_RUNS = [StructField("__h", ArrayType(StringType())), StructField("__p", ArrayType(StringType()))]


def _letter_runs(names: list[str]):
    """Arrow function: input columns, then host and path, to the columns and the runs of both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.columns
            made = [pa.array([_LETTERS.findall((t or "").lower()) for t in c.to_pylist()], pa.list_(pa.string())) for c in cols[-2:]]
            yield pa.RecordBatch.from_arrays([*cols, *made], names=names)
    return run


def _weak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, html) to (bad, host, path)."""
    for batch in batches:
        for rows in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
            bad = pa.array([looks_bad(visible(h)) for h in rows.column(2).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([bad, rows.column(0), rows.column(1)], names=["bad", "host", "path"])


def _with_runs(df: DataFrame) -> DataFrame:
    """A table that ends with host and path, written with their runs of letters and a row key."""
    schema = StructType([*df.schema.fields, *_RUNS])
    return store.with_row_key(df.mapInArrow(_letter_runs(schema.names), schema), "__row")


def _uses(keyed: DataFrame) -> DataFrame:
    """(__row, mark, at, run): the runs of every row; host words and path words count apart."""
    def of(column: str, mark: str) -> DataFrame:
        return keyed.select("__row", F.lit(mark).alias("mark"), F.posexplode(column).alias("at", "run"))
    return of("__h", "h:").union(of("__p", "p:"))


@dataclass
class Model:
    """Multinomial naive Bayes over url words, with add-one smoothing: weights as a table (word, weight)."""

    lexicon: Lexicon
    weights: DataFrame
    bias: float


def learn(pages: DataFrame, url: str = "url", html: str = "html") -> Model:
    """Word counts of the pages' text, and of their urls per weak label; over all pages."""
    lex = lexicon(pages, html)
    src = pages.filter(F.col(html).isNotNull()).select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html))
    keyed = _with_runs(src.mapInArrow(_weak, "bad boolean, host string, path string"))
    uses = _uses(keyed)
    words = segmented(uses, lex)
    seeded = words.filter(F.arrays_overlap("words", F.array(*map(F.lit, SEED_WORDS)))).select("run")
    rows = uses.filter("mark = 'h:'").join(seeded, "run", "left_semi").select("__row").distinct().withColumn("seeded", F.lit(True))
    labels = store.materialise(keyed.select("__row", "bad").join(rows, "__row", "left").select(
        "__row", (F.col("bad") | F.col("seeded").isNotNull()).alias("block")))
    n_block, n_all = labels.agg(F.count_if("block"), F.count("*")).first()
    # Runs are counted before they become words, and the counts written, so a run in most urls is few rows.
    used = store.materialise(uses.join(labels, "__row").groupBy("mark", "run").agg(
        F.count_if("block").alias("block"), F.count_if(~F.col("block")).alias("allow")))
    counts = store.materialise(
        used.join(words, "run").select("mark", "block", "allow", F.explode("words").alias("word"))
        .groupBy(F.concat("mark", "word").alias("word")).agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")))
    size, block, allow = counts.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0))).first()
    weight = F.log((F.col("block") + 1) / F.lit(float(block + size + 1))) - F.log((F.col("allow") + 1) / F.lit(float(allow + size + 1)))
    return Model(lex, counts.select("word", F.round(weight * UNIT).cast("long").alias("weight")),
                 math.log((n_block + 1) / (n_all - n_block + 1)))


def judge(pages: DataFrame, model: Model, url: str = "url", rules: tuple = RULES, prefix: str = "") -> DataFrame:
    """The pages plus host, path, rule, verdict, words and score (log odds of block).

    Words that no page had while learning say nothing.  Input columns with
    these names are replaced.
    """
    store.prepare(pages.sparkSession)
    pages = store.clear(pages, *(prefix + n for n in ("host", "path", "rule", "verdict", "words", "score")))
    keyed = _with_runs(pages.withColumns({"__host": host_of(F.col(url)), "__path": path_of(F.col(url))}))
    uses = _uses(keyed)
    words = segmented(uses, model.lexicon)
    marked = uses.select("mark", "run").distinct().join(words, "run")
    weighed = (marked.select("mark", "run", F.explode("words").alias("word"))
               .join(model.weights.withColumnRenamed("word", "__word"), F.concat("mark", "word") == F.col("__word"))
               .groupBy("mark", "run").agg(F.sum("weight").alias("weight")))
    scored = store.materialise(marked.join(weighed, ["mark", "run"], "left").select(
        "mark", "run", "words", F.coalesce("weight", F.lit(0)).alias("weight")))
    per = uses.join(scored, ["mark", "run"]).groupBy("__row").agg(
        F.sum("weight").alias("__weight"), F.sort_array(F.collect_list(F.struct("mark", "at", "words"))).alias("__words"))
    rule, verdict = rule_for(F.col("__host"), F.col("__path"), rules)
    score = F.lit(model.bias) + F.coalesce(F.col("__weight"), F.lit(0)) / UNIT
    text = F.flatten(F.transform("__words", lambda x: F.transform(x["words"], lambda w: F.concat(x["mark"], w))))
    made = {"host": F.col("__host"), "path": F.col("__path"), "rule": rule,
            "verdict": F.coalesce(verdict, F.when(score > 0, "block").otherwise("allow")),
            "words": F.coalesce(F.array_join(text, " "), F.lit("")), "score": score}
    return keyed.join(per, "__row", "left").select(
        *[F.col(f"`{c}`") for c in pages.columns], *[c.alias(prefix + n) for n, c in made.items()])
