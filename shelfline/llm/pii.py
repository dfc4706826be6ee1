"""Personal data: detected entities get keyed, type-consistent surrogates.

1. ``detect`` finds e-mail addresses, phone numbers, card and account numbers
   (with a right check digit), social security numbers, IP addresses (4 and 6),
   secrets, and names behind a title or where somebody gives their own name, as
   spans of a text.
2. ``assign`` gives every distinct entity (type and normal form) of the corpus
   one surrogate, derived from a key: same type, script, length and letter
   case pattern, gendered for given names, right check digits.  Candidates that
   meet another entity's surrogate, or a real entity of the corpus, are drawn
   again; after ``SAME_LENGTH_DRAWS`` draws each further one is a character
   longer, so all become distinct however crowded a format is.
3. ``replace`` writes the surrogates into the texts in each mention's own
   format, so two spellings of one number stay one number.

Only documents with entities are shuffled (by row, to meet their surrogates);
all others pass from the scan straight through.

Defined cases: null and empty texts stay as they are; a text may be one long
word; overlapping finds go to the type listed first; equal entities share one
surrogate everywhere; rows with null or repeated doc_id are separate rows;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import secrets
import unicodedata
from collections.abc import Iterator
from itertools import count, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

#: Session setting with the key; Spark redacts settings with "secret" in their names.
KEY_SETTING = "spark.shelfline.surrogates.secret"
#: Draws of an entity's own length; each one beyond is a character longer.
SAME_LENGTH_DRAWS = 16

# Titles and the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Señor": "m", "Sr": "m", "Monsieur": "m", "Don": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Señora": "f", "Sra": "f", "Madame": "f",
    "Mme": "f", "Mlle": "f", "Doña": "f", "Dr": "n", "Prof": "n",
    "господин": "m", "госпожа": "f", "г-н": "m", "г-жа": "f", "κύριος": "m", "κυρία": "f",
}
# How people begin to give their own name.
INTRODUCTIONS = ("my name is", "je m'appelle", "mein name ist", "ich heiße", "me llamo", "mi nombre es", "mi chiamo",
                 "меня зовут", "казвам се", "με λένε")
_INTRODUCED = r"(?i:" + "|".join(w.replace(" ", r"[ \xa0]") for w in INTRODUCTIONS) + ")"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_][^\W\d_]*(?:['’\-][^\W\d_]+)*"
PATTERN = re.compile("|".join((
    r"(?P<EMAIL>(?<![\w.%+\-])[\w.%+\-]+@[^\W_](?:[\w\-]*[^\W_])?(?:\.[^\W_](?:[\w\-]*[^\W_])?)+)",
    r"(?:(?i:token|secret|password|passwd|api[_\-]?key|access[_\-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?)(?P<SECRET>[A-Za-z0-9+/_\-]{8,}={0,2})",
    r"(?P<SECRET2>(?<![A-Za-z0-9])(?:(?=[a-f]*\d)(?=\d*[a-f])[0-9a-f]{32,}|(?=[A-F]*\d)(?=\d*[A-F])[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9\-]{20,})(?![A-Za-z0-9]))",
    r"(?P<IBAN>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))",
    rf"(?P<IP>(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d))",
    r"(?P<IP6>(?<![\w:.])[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d))",
    r"(?P<CARD>(?<!\d)(?<!\d[.\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\d]))",
    r"(?P<PHONE>(?<![\d+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)|(?<![\d.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![.\-]?\d))",
    r"(?P<SSN>(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\-]?\d))",
    r"(?P<NAME>(?<!\w)(?:" + "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
    + rf")\.?[ \xa0]{_NAME}(?:[ \xa0]{_NAME}){{0,2}})",
    rf"(?<!\w){_INTRODUCED}[ \xa0](?P<SELF>{_NAME}(?:[ \xa0]{_NAME}){{0,2}})",
)))
_WORTH = re.compile(r"[0-9@=:]|(?<!\w)(?:" + "|".join(map(re.escape, TITLES)) + rf"|{_INTRODUCED})(?!\w)")
_DIGITS = re.compile(r"\D")
_DIGIT = re.compile(r"\d")
_RUN = re.compile(r"\d+")
_QUAD = re.compile(rf"{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)")
#: Digits after the country code, for countries where all numbers have as many.
PLANS = {"1": 10, "7": 10, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "47": 8, "48": 9, "52": 10,
         "61": 9, "90": 10, "91": 10, "351": 9, "420": 9}
#: Characters of a country's account numbers.
IBAN_LENGTHS = {c: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}.items() for c in countries.split()}


def _low(text: str) -> str:
    """Lower case, character by character (keeps the length)."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban_end(surface: str) -> int | None:
    """Length of the account number that ``surface`` begins with: whole groups, as many as make the check digits hold."""
    cuts = [len(surface), *(i for i in range(len(surface) - 1, 0, -1) if surface[i] == " ")]
    cuts = [i for i in cuts if i - surface.count(" ", 0, i) >= 15]
    # The country's own length first, then the longest.
    own = IBAN_LENGTHS.get(surface[:2])
    cuts.sort(key=lambda i: i - surface.count(" ", 0, i) != own)
    return next((i for i in cuts if _iban_ok(surface[:i].replace(" ", ""))), None)


def _address(surface: str) -> ipaddress.IPv6Address | None:
    try:
        return ipaddress.IPv6Address(surface)
    except ValueError:
        return None


def _plain(surface: str) -> str:
    """The digits of a number, as 0-9."""
    return "".join(str(unicodedata.digit(c)) for c in _DIGITS.sub("", surface))


def _complete(surface: str) -> bool:
    """Whether a number that begins with + ends where a space follows ``surface``."""
    runs = [(m.start(), _plain(m[0])) for m in _RUN.finditer(surface)]
    # A bracketed 0 is dialled within the country only.
    digits = "".join(d for i, (at, d) in enumerate(runs) if not (i and d == "0" and surface[at - 1] == "("))
    plan = next((n for c in (1, 2, 3) if (n := PLANS.get(digits[:c], 0) + c) > c), None)
    if plan:
        return len(digits) == plan
    # Other countries: after a last group of 6 digits or more, or one joined on by - or . (a space is another style).
    return len(digits) >= 10 and (len(runs[-1][1]) >= 6 or surface[runs[-1][0] - 1] in ".-")


def _phone_end(text: str, a: int, b: int) -> int | None:
    """Where the number with 8 to 15 digits ends that begins with the + at ``a``; what follows it by ``b`` is not its own."""
    n, end, spaced = 0, None, None
    for m in _RUN.finditer(text, a, b):
        s, e = m.span()
        if end is not None and text[end:s] == " ":
            quad = _QUAD.match(text, s)
            if quad and (n >= 8 or n + len(_plain(quad[0])) > 15):
                break
            if n >= 8:
                if _complete(text[a:end]) or ((m := PATTERN.match(text, s)) and _accept(text, m)):
                    break
                spaced = end
        if n + e - s > 15:
            # Too long for one number: it ended at a space, or else at a mark.
            end = spaced or end
            break
        n, end = n + e - s, e
    return end if end is not None and len(_plain(text[a:end])) >= 8 else None


def _accept(text: str, m: re.Match) -> tuple[int, int, str, str] | None:
    """(start, end, type, normal form) of a match; None where it is no entity (or a name)."""
    kind = m.lastgroup
    a, b = m.span(kind)
    if kind == "PHONE" and text[a] == "+":
        b = _phone_end(text, a, b)
        if b is None:
            return None
    surface = text[a:b]
    if kind == "SECRET2":
        kind = "SECRET"
    if kind == "EMAIL":
        return a, b, kind, _low(surface)
    if kind in ("CARD", "PHONE", "SSN"):
        digits = _plain(surface)
        if kind == "CARD" and not luhn(digits):
            return None
        if kind == "PHONE":
            # With or without the country code 1 it is one number.
            digits = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
        return a, b, kind, digits
    if kind == "IBAN":
        n = _iban_end(surface)
        return n and (a, a + n, kind, surface[:n].replace(" ", ""))
    if kind == "IP6":
        # One address however it is shortened; without a digit it may be words.
        one = _address(surface) if _DIGIT.search(surface) else None
        return one and (a, b, "IP", str(one))
    return None if kind == "NAME" else (a, b, kind, surface)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of the entities of a text, in order."""
    if not _WORTH.search(text):
        return []
    out, known = [], {}
    m = PATTERN.search(text)
    while m:
        if m.lastgroup in ("NAME", "SELF"):
            at, b = m.span(m.lastgroup)
            words, gender, own = re.split(r"[ \xa0]", text[at:b]), "n", m.lastgroup == "SELF"
            if not own:
                gender = TITLES[words[0].rstrip(".")]
                at += len(words.pop(0)) + 1
            # A name ends before a small letter; a title in an introduction begins a match of its own.
            words = list(takewhile(lambda w: w[0].isupper() and not (own and w in TITLES), words))
            taken = b if words else None
            for i, w in enumerate(words):
                last = i == len(words) - 1 and not (own and len(words) == 1)
                k = "SURNAME" if last else f"GIVEN_{gender.upper()}"
                out.append((at, at + len(w), k, _low(w)))
                known.setdefault(w, k)
                at += len(w) + 1
        else:
            one = _accept(text, m)
            out += [one] if one else []
            taken = one and one[1]
        # Behind an entity; inside a match that is none, where another may begin.
        m = PATTERN.search(text, m.start() + 1 if taken is None else taken)
    if known:  # later or earlier bare mentions of the same names
        taken = [(a, b) for a, b, *_ in out]
        again = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, known), key=len, reverse=True)) + r")(?!\w)")
        starts = np.array([a for a, _ in sorted(taken)])
        ends = np.array([b for _, b in sorted(taken)])
        for m in again.finditer(text):
            i = int(np.searchsorted(starts, m.end())) - 1
            if i < 0 or ends[i] <= m.start():
                out.append((m.start(), m.end(), known[m[0]], _low(m[0])))
        out.sort()
    return out


class Draw:
    """Characters drawn from a key, an entity and a draw number."""

    def __init__(self, key: str, *what: str | int):
        self._seed = hmac.new(key.encode(), "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest()
        self._pool, self._n = b"", 0

    def below(self, n: int) -> int:
        if len(self._pool) < 4:
            self._pool += hashlib.sha256(self._seed + self._n.to_bytes(4, "big")).digest()
            self._n += 1
        value, self._pool = int.from_bytes(self._pool[:4], "big"), self._pool[4:]
        return value % n

    def of(self, choices: str) -> str:
        return choices[self.below(len(choices))]


# Vowels and consonants by script, lower case.
SCRIPTS = {
    "LATIN": ("aeiou", "bdfgklmnprstvz"),
    "CYRILLIC": ("аеиоу", "бвгдзклмнпрст"),
    "GREEK": ("αεηιο", "βγδκλμνπρστ"),
}


def _script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "").split(" ")[0]
            return name if name in SCRIPTS else "LATIN"
    return "LATIN"


def _letters(draw: Draw, shape: str) -> str:
    """Digits for digits, pronounceable letters for letters, the rest as it is."""
    out, vowel = [], draw.below(2)
    for c in shape:
        if c.isdigit():
            out.append(draw.of("0123456789"))
        elif c.isalpha():
            vowels, consonants = SCRIPTS[_script(c)]
            out.append(draw.of(vowels if vowel else consonants))
            vowel = not vowel
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: str, kind: str, norm: str, attempt: int) -> str:
    """The normal form of the surrogate that a draw gives an entity; late draws are longer."""
    draw = Draw(key, kind, norm, attempt)
    more = max(attempt + 1 - SAME_LENGTH_DRAWS, 0)
    digits = lambda n: "".join(draw.of("0123456789") for _ in range(n))
    if kind == "EMAIL":
        user, _, host = norm.rpartition("@")
        name, _, top = host.rpartition(".")
        # One host keeps one surrogate host; the top-level name stays.
        return f"{_letters(draw, user + 'a' * more)}@{_letters(Draw(key, 'HOST', host, attempt), name)}.{top}"
    if kind == "PHONE":
        head = norm[:-10] if len(norm) > 10 else ""
        rest = norm[len(head):]
        made = digits(len(rest) + more)
        return head + (draw.of("23456789") + made[1:] if rest[0] != "0" else "0" + made[1:])
    if kind == "CARD":
        made = norm[0] + digits(len(norm) - 2 + more)
        return made + next(d for d in "0123456789" if luhn(made + d))
    if kind == "SSN":
        return digits(len(norm) + more)
    if kind == "IP":
        if ":" not in norm and not more:
            return ".".join(str(1 + draw.below(254)) for _ in range(4))
        # Version 6; zeros stay zeros.  It has room where the other version has none left.
        groups = _address(norm).exploded.split(":")[1:] if ":" in norm and not more else ["1"] * 7
        made = [0x2000 + draw.below(0x1000), *(int(g, 16) and 1 + draw.below(0xFFFF) for g in groups)]
        return str(ipaddress.IPv6Address(":".join(f"{g:x}" for g in made)))
    if kind == "IBAN":
        rest = "".join(draw.of("0123456789") if c.isdigit() else draw.of("ABCDEFGHJKLMNPRSTUVWXYZ") for c in norm[4:]) + digits(more)
        check = 98 - int("".join(str(int(c, 36)) for c in rest + norm[:2] + "00")) % 97
        return f"{norm[:2]}{check:02d}{rest}"
    if kind == "SECRET":
        sets = ("0123456789abcdef", "0123456789ABCDEF")
        hexes = next((s for s in sets if set(norm) <= set(s)), None)
        if hexes:
            return "".join(draw.of(hexes) for _ in range(len(norm) + more))
        low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        pick = lambda c: draw.of("0123456789" if c.isdigit() else up if c.isupper() else low) if c.isalnum() else c
        return "".join(map(pick, norm)) + digits(more)
    # Names: syllables of the script; longer with each draw; a gendered ending.
    script = _script(norm)
    vowels, consonants = SCRIPTS[script]
    stem = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(2 + draw.below(2) + attempt // 2))
    ending = {"GIVEN_F": vowels[0], "GIVEN_M": draw.of(consonants)}.get(kind)
    if ending is None:  # surnames keep a final vowel or consonant, which some scripts inflect by gender
        ending = vowels[0] if norm[-1] in vowels else draw.of(consonants)
    return (stem[:-1] + ending) if ending in vowels else stem + ending


def _cased(surface: str, made: str) -> str:
    put = [m.upper() if c.isupper() and len(m.upper()) == 1 else m for c, m in zip(surface, made, strict=False)]
    return "".join(put) + made[len(surface):]


def render(surface: str, kind: str, made: str) -> str:
    """A surrogate in the format of one mention; what is longer than the mention stands before or behind it."""
    if kind in ("CARD", "PHONE", "SSN"):
        out, places = list(surface), [i for i, c in enumerate(surface) if c.isdigit()]
        for i, c in zip(reversed(places), reversed(made), strict=False):
            out[i] = c
        if len(made) > len(places):
            out[places[0]] = made[:len(made) - len(places) + 1]
        return "".join(out)
    if kind == "IBAN":
        left = iter(made)
        return "".join([c if c == " " else next(left) for c in surface] + list(left))
    if kind == "EMAIL":
        (user, _, host), (own, _, other) = surface.rpartition("@"), made.rpartition("@")
        return f"{_cased(user, own)}@{_cased(host, other)}"
    if kind == "IP" and ":" in surface:
        whole = ipaddress.IPv6Address(made).exploded.split(":")
        if "::" not in surface:
            full = all(len(g) == 4 for g in surface.split(":"))
            made = ":".join(whole if full else [f"{int(g, 16):x}" for g in whole])
        return made.upper() if surface.isupper() else made
    if kind in ("IP", "SECRET"):
        return made
    return made.upper() if surface.isupper() and len(surface) > 1 else made[0].upper() + made[1:]


FOUND = (("__type", StringType()), ("__norm", StringType()), ("__start", IntegerType()), ("__end", IntegerType()))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents plus parallel arrays __type, __norm, __start, __end (characters)."""
    store.prepare(docs.sparkSession)
    schema = StructType(docs.schema.fields + [StructField(n, ArrayType(t)) for n, t in FOUND])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in B.slices(batches, text):
            col = rows.column(rows.schema.get_field_index(text)).to_pylist()
            found = [find(t) if t else [] for t in col]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32())
            cols = [pa.array([[e[i] for e in x] for x in found], pa.list_(k)) for i, k in zip((2, 3, 0, 1), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *cols], names=names)

    return docs.mapInArrow(run, schema)


def session_key(spark: SparkSession) -> str:
    """The key in ``KEY_SETTING``; where there is none, one is drawn for this session.

    Who needs the same surrogates in another session sets it.
    """
    if not spark.conf.get(KEY_SETTING, ""):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def assign(entities: DataFrame, key: str | None = None) -> DataFrame:
    """(type, norm, surrogate) for distinct entities (type, norm); surrogates are distinct and no entities."""
    spark = entities.sparkSession
    store.prepare(spark)
    key = key or session_key(spark)
    every = store.materialise(entities.select("type", "norm").distinct())
    pending, done = every.withColumn("attempt", F.lit(0)), None

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, *r) for r in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                             names=["type", "norm", "attempt", "surrogate"])

    for _ in count():
        drawn = store.materialise(pending.mapInArrow(draw, "type string, norm string, attempt int, surrogate string"))
        least = drawn.groupBy("type", "surrogate").agg(F.min("norm").alias("norm"))
        fine = least.join(every.select("type", F.col("norm").alias("surrogate")), ["type", "surrogate"], "left_anti")
        if done is not None:
            fine = fine.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        fine = fine.select("type", "norm", "surrogate")
        done = store.materialise(fine if done is None else done.union(fine))
        pending = drawn.join(done.select("type", "norm"), ["type", "norm"], "left_anti").select(
            "type", "norm", (F.col("attempt") + 1).alias("attempt"))
        pending = store.materialise(pending)
        if not pending.head(1):
            return done


def replace(docs: DataFrame, text: str = "text", key: str | None = None, report: str | None = "entities") -> DataFrame:
    """The documents with surrogates in ``text``, drawn by ``key`` (by default ``session_key``).

    ``report`` names a column array<struct<type, start, end, surrogate>> of the
    replaced spans (positions in the original text, surrogate as written); an
    input column of that name is replaced.
    """
    spark = docs.sparkSession
    store.prepare(spark)
    docs = store.clear(docs, *([report] if report else []))
    found = detect(docs, text)
    hit = F.size("__type") > 0
    mine = store.materialise(found.filter(hit).withColumn("__row", F.monotonically_increasing_id()))
    spans = mine.select("__row", F.posexplode(F.arrays_zip("__type", "__norm")).alias("at", "e")).select(
        "__row", "at", F.col("e.__type").alias("type"), F.col("e.__norm").alias("norm"))
    given = assign(spans.select("type", "norm"), key)
    per = (spans.join(given, ["type", "norm"]).groupBy("__row")
           .agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("__made")))
    joined = mine.join(per, "__row").select(*found.columns, F.col("__made.surrogate").alias("__made"))
    fields = list(docs.schema.fields)
    if report:
        kind = StructType([StructField("type", StringType()), StructField("start", IntegerType()),
                           StructField("end", IntegerType()), StructField("surrogate", StringType())])
        fields.append(StructField(report, ArrayType(kind)))
    schema = StructType(fields)
    names, where, width = schema.names, docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in B.slices(batches, text):
            texts, spans = [], []
            cols = [rows.column(i).to_pylist() for i in (where, width, width + 2, width + 3, width + 4)]
            for t, kinds, starts, ends, made in zip(*cols, strict=True):
                parts, last, own = [], 0, []
                for k, a, b, m in zip(kinds, starts, ends, made, strict=True):
                    put = render(t[a:b], k, m)
                    parts += [t[last:a], put]
                    last = b
                    own.append({"type": k, "start": a, "end": b, "surrogate": put})
                texts.append("".join([*parts, t[last:]]))
                spans.append(own)
            out = list(rows.columns[:width])
            out[where] = pa.array(texts, pa.string())
            if report:
                out.append(pa.array(spans, _arrow_spans()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    changed = joined.mapInArrow(run, schema)
    same = found.filter(~hit).select(*docs.columns)
    if report:
        same = same.withColumn(report, F.array().cast(schema[report].dataType))
    return same.union(changed)


def _arrow_spans() -> pa.DataType:
    return pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))
