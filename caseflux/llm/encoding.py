"""Problem 2: text read in the wrong encoding, found and restored.

Records are joined with near-twins on their text without non-ASCII characters;
where such twins differ, the runs at the same place are aligned (a place is the
text on one side of the run).  A run that is its twin's run read in some other way (UTF-8 bytes in another code page,
once, twice or cut short; Windows signs as control characters) is garbled and
gives evidence for that way of reading.  The code pages below are only the
ways that may be learned: a way without evidence is never applied.  What was
learned, ways and single mappings, is then applied to all records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

# Code pages in which UTF-8 bytes are commonly read.
SINGLE_BYTE = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "cp1250", "cp1253", "cp1254", "iso8859-15", "iso8859-2", "cp866", "koi8-r")
DOUBLE_BYTE = ("gbk", "shift_jis", "big5")
# Characters beside accented Latin letters that texts of any language hold.
PLAIN_SIGNS = " ¡¢£¥§©«®°±²³·»¼½¾¿–—‘’‚“”„†‡•…‰‹›€™"
RUN = re.compile(r"[^\x00-\x7f]+")
#: Characters that no reading of correct text yields.
LOST = re.compile("[\u0080-\u009f�]")
#: What garbled text cannot do without; single accented letters are not looked at further.
SUSPECT = re.compile("[^\\x00-\\x7f]{2}|[\u0080-\u009f\ufffd\u2e80-\uffef]|(?<=[a-z])[ÃÂ]")
MAX_PASSES = 3


def _plausible(text: str) -> bool:
    """Could the decoded characters stand in text? Other scripts: only two or more."""
    other = 0
    for c in text:
        o = ord(c)
        if o < 0x80 or c in PLAIN_SIGNS or (0xC0 <= o <= 0x17F and o not in (0xD7, 0xF7)) or o in (0x218, 0x219, 0x21A, 0x21B) or 0x1E00 <= o <= 0x1EFF:
            continue
        if not c.isalpha() or 0x180 <= o <= 0x2AF:
            return False
        other += 1
    return other != 1


@lru_cache(maxsize=None)
def _page(codec: str) -> dict[str, int]:
    """Character -> byte of the upper half; undefined bytes stand for themselves."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            table.setdefault(chr(b), b)
    return table


@lru_cache(maxsize=None)
def _pattern(codec: str) -> re.Pattern:
    """Sequences that are UTF-8 when written in ``codec``, and cut-off ones of three bytes."""
    page = _page(codec)
    cls = lambda lo, hi: "[" + re.escape("".join(c for c, b in page.items() if lo <= b <= hi)) + "]"
    tail = cls(0x80, 0xBF)
    return re.compile(f"(?:{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+")


@lru_cache(maxsize=None)
def _cut_quotes() -> re.Pattern:
    """The first two of three bytes of a typographic sign, in each code page."""
    heads = []
    for codec in (*SINGLE_BYTE, *DOUBLE_BYTE):
        try:
            heads.append(b"\xe2\x80".decode(codec))
        except UnicodeDecodeError:
            pass
    heads = sorted({re.escape(h) for h in heads if len(h) == 2 or ord(h) > 0x2E7F})
    return re.compile("|".join([*heads, r"(?<=[a-z])[ÃÂ](?![a-z\x80-\xbf])"]))


def _decode(found: str, codec: str) -> str | None:
    page = _page(codec)
    try:
        out = bytes(page[c] for c in found).decode("utf-8")
    except (UnicodeDecodeError, KeyError):
        return None
    if _plausible(out):
        return out
    for again in (codec, *SINGLE_BYTE[:4]):  # read wrongly twice: the first result is no text yet
        twice = _pattern(again).sub(lambda m: _plain_decode(m[0], again) or m[0], out)
        if twice != out and _plausible(twice):
            return twice
    return None


def _plain_decode(found: str, codec: str) -> str | None:
    page = _page(codec)
    try:
        return bytes(page[c] for c in found).decode("utf-8")
    except (UnicodeDecodeError, KeyError):
        return None


def _decode_double(run: str, codec: str) -> str | None:
    try:
        out = run.encode(codec).decode("utf-8")
    except UnicodeError:
        return None
    return out if out != run and _plausible(out) and all(ord(c) < 0x2E80 for c in out) else None


ALL_WAYS = (*SINGLE_BYTE, *DOUBLE_BYTE, "control", "cut")


def repair(text: str, mappings: dict[str, str] | None = None, ways: tuple[str, ...] = ALL_WAYS) -> tuple[str, bool, bool]:
    """(restored text, was it garbled, is nothing left that is lost), by the given ways of reading."""
    if text.isascii() or not SUSPECT.search(text) and not (mappings and any(m in text for m in mappings)):
        return text, False, True
    garbled = False
    for bad, good in (mappings or {}).items():
        if bad in text:
            text, garbled = text.replace(bad, good), True
    double = [c for c in DOUBLE_BYTE if c in ways]
    for _ in range(MAX_PASSES):
        before = text
        for codec in ways:
            if codec in SINGLE_BYTE:
                text = _pattern(codec).sub(lambda m, c=codec: _decode(m[0], c) or m[0], text)
        if text == before and double:
            text = RUN.sub(lambda m: next((x for c in double if (x := _decode_double(m[0], c))), m[0]), text)
        if text == before:
            break
        garbled = True
    if "control" in ways and LOST.search(text):
        text, garbled = "".join(map(_windows_sign, text)), True
    garbled = garbled or "\ufffd" in text  # the sign of a failed reading, by definition
    if not garbled and "cut" in ways and _cut_quotes().search(text):
        garbled = True
    return text, garbled, not LOST.search(text) and not _cut_quotes().search(text)


def _windows_sign(c: str) -> str:
    return bytes([ord(c)]).decode("cp1252", "ignore") or c if "\x80" <= c <= "\x9f" else c


def _cut_readings(good: str) -> Iterator[str]:
    """What is seen of the UTF-8 bytes of ``good`` in some code page when the last ones are lost."""
    raw = good.encode("utf-8", "surrogatepass")
    for codec in (*SINGLE_BYTE, *DOUBLE_BYTE):
        for k in range(2, len(raw)):
            seen = raw[:k].decode(codec, "ignore")
            if seen and seen != good:
                yield seen


def readings(run: str) -> Iterator[tuple[str, str, str]]:
    """(bad, good, way) that the run may be part of, on the strength of its characters alone."""
    for codec in SINGLE_BYTE:
        fixed = _pattern(codec).sub(lambda m, c=codec: _decode(m[0], c) or m[0], run)
        if fixed != run:
            yield run, fixed, codec
    for codec in DOUBLE_BYTE:
        fixed = _decode_double(run, codec)
        if fixed:
            yield run, fixed, codec
    if LOST.search(run) and (fixed := "".join(map(_windows_sign, run))) != run:
        yield run, fixed, "control"
    if len(run) == 1 and run in PLAIN_SIGNS:
        for bad in set(_cut_readings(run)):
            yield bad, run, "cut"


def _hypotheses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [x for run in b.column(0).to_pylist() for x in readings(run)]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in range(3)], ["bad", "good", "way"])


#: Characters on either side of a run in which near-twins must agree, blanks apart.
BESIDE = 10


def aligned_runs(texts: DataFrame) -> DataFrame:
    """(key, run): every distinct run of non-ASCII characters by the ASCII text beside it.

    Near-twins agree in the whole text, in the characters before the run, or in
    those after it, once non-ASCII characters and blanks are taken out; the key
    is any of these.
    """
    t = F.col(texts.columns[0])
    runs = F.regexp_extract_all(t, F.lit("([^\\x00-\\x7f]+)"), F.lit(1))
    between = F.transform(F.split(t, "[^\\x00-\\x7f]+"), lambda s: F.regexp_replace(s, "\\s+", ""))
    rows = texts.where(t.rlike("[^\\x00-\\x7f]")).select(between.alias("b"), F.posexplode(runs).alias("k", "run"))
    before, after = F.substring(F.col("b")[F.col("k")], -BESIDE, BESIDE), F.substring(F.col("b")[F.col("k") + 1], 1, BESIDE)
    keys = F.array(F.when(F.length(before) >= BESIDE // 2, F.xxhash64(F.lit(0), before)), F.when(F.length(after) >= BESIDE // 2, F.xxhash64(F.lit(1), after)), F.xxhash64(F.lit(2), "b", "k"))
    return rows.select(F.explode(keys).alias("key"), "run").where("key is not null").distinct()


def learn_mappings(texts: DataFrame, work: Workspace) -> DataFrame:
    """(bad, good, codec, support) from near-twins (one string column), support in places.

    A run that may be its twin's run read in some way is held against the runs
    of the same place by an equal join on place and text, so no group of twins
    is paired with itself.  ``codec`` is the way, or ``other`` where several
    characters stand for one at many places and no known way explains it.
    """
    placed = work.save(aligned_runs(texts), "aligned_runs")
    known = work.save(placed.select("run").distinct().mapInArrow(_hypotheses, "bad string, good string, way string").distinct(), "readings")
    seen = placed.join(known, placed["run"] == known["bad"]).select("key", "bad", "good", "way")
    twins = placed.select("key", F.col("run").alias("good"))
    proved = seen.join(twins, ["key", "good"]).groupBy("bad", "good", F.col("way").alias("codec")).agg(F.count("*").alias("support"))
    strange = placed.join(known.select(F.col("bad").alias("run")).distinct(), "run", "left_anti").where(F.length("run") > 1)
    single = F.when(F.length("good") == 1, F.col("good"))
    plain = twins.groupBy("key").agg(F.min(single).alias("good"), F.max(single).alias("last")).where("good = last")
    other = strange.join(plain, "key").groupBy(F.col("run").alias("bad"), "good").agg(F.count("*").alias("support")).select("bad", "good", F.lit("other").alias("codec"), "support")
    return proved.unionByName(other)


class Learned:
    """Ways of reading by their evidence, and mappings that no way explains."""

    #: Most bytes of single mappings that go to the executors, else an error.
    MOST_BYTES = 16 << 20
    #: Places at which twins must show a mapping that no way explains.
    LEAST_PLACES = 4

    def __init__(self, mappings: DataFrame, work: Workspace, name: str = "mappings"):
        kept = work.save(mappings, name)
        self.support = {r["codec"]: r["n"] for r in kept.where("codec <> 'other'").groupBy("codec").agg(F.sum("support").alias("n")).collect()}
        self.ways = tuple(sorted(self.support, key=lambda w: (-self.support[w], ALL_WAYS.index(w))))
        # a sequence that no way explains is replaced where many twins agree on what it was
        other = kept.where("codec = 'other'").groupBy("bad").agg(F.min("good").alias("good"), F.max("good").alias("last"), F.sum("support").alias("n"))
        other = other.where((F.col("good") == F.col("last")) & (F.col("n") >= self.LEAST_PLACES)).select("bad", "good")
        if (other.agg(F.sum(F.octet_length("bad") + F.octet_length("good"))).first()[0] or 0) > self.MOST_BYTES:
            raise ValueError("the mappings are too many to be sent to every executor")
        self.mappings = {r["bad"]: r["good"] for r in sorted(other.collect(), key=lambda r: (-len(r["bad"]), r["bad"]))}


def _repairer(mappings: dict[str, str], ways: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = b.column(0).to_pylist(), []
            for i, t in zip(ids, b.column(1).to_pylist()):
                fixed, garbled, whole = repair(t, mappings, ways)
                if garbled:
                    out.append({"id": i, "text": t, "restored": fixed, "complete": whole})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("id", pa.string()), ("text", pa.string()), ("restored", pa.string()), ("complete", pa.bool_())]))

    return run


def restore_garbled(rows: DataFrame, id_col: str, text: str, work: Workspace, learned: Learned | None = None) -> DataFrame:
    """(id, text, restored, complete) of the garbled records, once for each text.

    ``learned`` has what twins taught; it is learned from ``rows`` themselves
    where it is not given.  ``complete`` is false where characters were lost
    for good.  Nulls, empty and correct texts give no row; correct foreign
    letters stay as they are.
    """
    read = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    read = read.where(F.col("text").rlike("[^\\x00-\\x7f]"))
    learned = learned or Learned(learn_mappings(read.select("text"), work), work)
    return read.mapInArrow(_repairer(learned.mappings, learned.ways), "id string, text string, restored string, complete boolean").dropDuplicates(["id", "text"])
