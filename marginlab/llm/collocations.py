"""Phrase collocations by stripes.

A stripe is a prefix with an associative counter of the words that follow it. Tasks
count the stripes of their texts; stripes of one prefix are merged elementwise by
the task that owns it. The empty prefix gives the words, a prefix of k words the
phrases of k + 1. A merged stripe holds the frequencies of all extensions of its
prefix, its total at the empty prefix is the number of words, and the greatest of
its counters tells whether an extension to the right subsumes the prefix; the same
counters under the phrase without its first word tell it for extensions to the left.

Levels follow each other: a phrase reaches the least frequency only if the phrases
without its first and its last word do. These are known when a level is counted, by
a bit map of fixed size over hashes of the frequent phrases of the level before. A bit
can be set by another phrase, so some rare phrases are counted too, and left out when
their stripe is merged; no frequent one is missed.

The stripe of a word like an article is long and has a part in every task. Prefixes
with more than one in ``PARTS`` of all words are cut into parts by the hash of the
following word, in proportion to their frequency; there are ``PARTS`` such prefixes at
most, so their list is bounded too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlab.session import new_shared_path

#: Bytes of text of one language that a task cuts at once, and words that it counts before it lets go of them.
CUT_BYTES, COUNTED_WORDS = 4 << 20, 2 << 20
#: Bits of the map of frequent phrases, as a power of two.
FILTER_BITS = 26
#: Parts of the stripe of the empty prefix, and of longer stripes by their share of all words.
PARTS = 1024

#: Ends of pieces become line feeds, the separators of words spaces.
_CHARACTERS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
#: Between pieces; no byte of UTF-8.
_END = b"\xff"
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LEVEL = "lang string, prefix binary, next binary, suffix binary, f long, slot long"


def _cut(texts: list[bytes]) -> list[bytes]:
    """Words of the texts, A-Z in lower case, with ``_END`` between pieces and texts."""
    return b"\n".join(texts).lower().translate(_CHARACTERS).replace(b"\n", b" \xff ").split()


class _Numbers(dict):
    """Numbers of words in the order in which they are met; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bit of the map that stands for each hash of a phrase."""
    h = (hashes ^ hashes >> np.uint64(32)) * _SPREAD
    return h >> np.uint64(64 - bits)


def _word_hash(word: bytes, lang: str) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


class _Counted:
    """Phrases of ``size`` words in the words of one language that a task holds.

    ``frequent`` tells by its bits which phrases of ``size`` - 1 words may reach the least frequency.
    """

    def __init__(self, words: _Numbers, ids: np.ndarray, lang: str, size: int, frequent: np.ndarray | None):
        self.words = list(words)
        self.hashes = np.array([_word_hash(w, lang) for w in self.words], np.uint64)
        if size == 1:
            found = np.bincount(ids, minlength=len(self.words))
            found[0] = 0
            self.next = np.flatnonzero(found)
            self.counts, self.prefix, self.prefixes = found[self.next], np.zeros(len(self.next), np.int64), [()]
            return
        bits = len(frequent).bit_length() + 2
        inside = ids != 0
        ok, rolled = inside, self.hashes[ids]
        first = rolled
        for k in range(1, size - 1):
            rolled = rolled[:-1] * _STEP + first[k:]
            ok = ok[:-1] & inside[k:]
        slots = _slots(rolled, bits)
        ok &= (frequent[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        at = np.flatnonzero(ok[:-1] & ok[1:])
        # A prefix is numbered from that of one word less and its last word.
        number, n = ids[at].astype(np.int64), len(self.words)
        ends = []
        for k in range(1, size - 1):
            codes, number = np.unique(number * n + ids[at + k], return_inverse=True)
            ends.append(codes)
        codes, self.counts = np.unique(number * n + ids[at + size - 1], return_counts=True)
        self.prefix, self.next = codes // n, codes % n
        kept, self.prefix = np.unique(self.prefix, return_inverse=True)
        columns = []
        for codes in reversed(ends):
            columns.append(codes[kept] % n)
            kept = codes[kept] // n
        self.prefixes = list(zip(*[c.tolist() for c in [kept, *reversed(columns)]]))

    def stripes(self, lang: str, parts_of: dict[bytes, int]) -> pa.RecordBatch | None:
        """(lang, prefix, part, nexts, counts): words are joined by a space, counts are 8 bytes each."""
        if not len(self.next):
            return None
        word = self.words.__getitem__
        prefixes = [b" ".join(map(word, p)) for p in self.prefixes]
        parts = np.array([parts_of.get(p, 1) for p in prefixes], np.uint64)[self.prefix]
        part = ((self.hashes[self.next] >> np.uint64(20)) % parts).astype(np.int64)
        order = np.lexsort((part, self.prefix))
        prefix, part, nexts, counts = self.prefix[order], part[order], self.next[order], self.counts[order].astype("<i8")
        edge = np.flatnonzero((np.diff(prefix) != 0) | (np.diff(part) != 0)) + 1
        starts = np.concatenate([[0], edge])
        ends = np.concatenate([edge, [len(prefix)]])
        texts = list(map(word, nexts.tolist()))
        raw = counts.tobytes()
        spans = list(zip(starts.tolist(), ends.tolist()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(starts)),
                pa.array([prefixes[i] for i in prefix[starts].tolist()], pa.binary()),
                pa.array(part[starts], pa.int32()),
                pa.array([b" ".join(texts[a:b]) for a, b in spans], pa.binary()),
                pa.array([raw[a * 8 : b * 8] for a, b in spans], pa.binary()),
            ],
            ["lang", "prefix", "part", "nexts", "counts"],
        )


def _count(size: int, frequent, parts_of: dict[str, dict[bytes, int]]):
    """A mapInArrow function over (lang, text): stripes of the prefixes of ``size`` - 1 words."""
    every = {b"": PARTS} if size == 1 else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        n = 0

        def let_go() -> Iterator[pa.RecordBatch]:
            for lang, (words, ids) in held.items():
                counted = _Counted(words, np.concatenate(ids), lang, size, frequent.value if frequent else None)
                out = counted.stripes(lang, every or parts_of.get(lang, {}))
                if out is not None:
                    yield out
            held.clear()

        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                while texts:
                    some, taken = [], 0
                    while texts and taken < CUT_BYTES:
                        some.append(texts.pop())
                        taken += len(some[-1])
                    words, ids = held.setdefault(lang, (_Numbers(), []))
                    tokens = _cut(some)
                    tokens.append(_END)
                    ids.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
                    n += len(tokens)
                    if n >= COUNTED_WORDS:
                        yield from let_go()
                        n = 0
        yield from let_go()

    return run


def _merge(size: int, least: int, bits: int):
    """A mapInArrow function over sorted stripes: the extensions that reach ``least``, and totals of the words (null ``next``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, {}
        known: dict[tuple, int] = {}

        def hash_of(word: bytes, lang: str) -> int:
            if len(known) > 1_000_000:
                known.clear()
            found = known.get((word, lang))
            if found is None:
                found = known[word, lang] = _word_hash(word, lang)
            return found

        def finished() -> list[tuple]:
            lang, prefix, _ = now
            found = [(w, f) for w, f in sums.items() if f >= least]
            rolled = 0
            for w in prefix.split():
                rolled = (rolled * int(_STEP) + hash_of(w, lang)) & 0xFFFFFFFFFFFFFFFF
            ends = np.array([hash_of(w, lang) for w, _ in found], np.uint64)
            hashes = np.array([rolled], np.uint64) * _STEP + ends if size > 1 else ends
            rest = prefix.partition(b" ")[2]
            rest = rest + b" " if rest else b""
            rows = [(w, rest + w if size > 1 else None, f, s) for (w, f), s in zip(found, _slots(hashes, bits).astype(np.int64).tolist())]
            if size == 1:
                rows.append((None, None, sum(sums.values()), None))
            return rows

        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "prefix", "next", "suffix", "f", "slot"])

        for batch in batches:
            for lang, prefix, part, nexts, counts in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if (lang, prefix, part) != now:
                    if now is not None:
                        out += [(*now[:2], *r) for r in finished()]
                    now, sums = (lang, prefix, part), {}
                    if len(out) > 50_000:
                        yield packed()
                get = sums.get
                for w, n in zip(nexts.split(b" "), np.frombuffer(counts, "<i8").tolist()):
                    sums[w] = get(w, 0) + n
        if now is not None:
            out += [(*now[:2], *r) for r in finished()]
        if out:
            yield packed()

    return run


def _map_of(level: DataFrame, bits: int) -> np.ndarray:
    """The bit map of the frequent phrases of a level: 2^bits bits, whatever their number."""
    words = level.where("slot is not null").groupBy(F.shiftright("slot", 6).alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def phrase_levels(
    docs: DataFrame, path: str, least: int, longest: int, bits: int = FILTER_BITS, lang: str = "lang", text: str = "text"
) -> list[DataFrame]:
    """Tables of the frequent words, pairs, ... in ``path``: ``lang``, ``prefix``, ``next``, ``suffix`` (without the first word), ``f``.

    The table of words has also a row with a null ``next`` for each part of a
    language's stripe: ``f`` adds up to the number of its words.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    levels, frequent, hot = [], None, {}
    for size in range(1, longest + 1):
        stripes = rows.mapInArrow(_count(size, frequent, hot), "lang string, prefix binary, part int, nexts binary, counts binary")
        owned = stripes.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
        owned.mapInArrow(_merge(size, least, bits), _LEVEL).write.parquet(f"{path}/{size}")
        level = spark.read.parquet(f"{path}/{size}")
        levels.append(level)
        if size == longest:
            break
        if size == 1:
            words = level.where("next is null").agg(F.sum("f")).first()[0] or 0
        frequent = spark.sparkContext.broadcast(_map_of(level, bits))
        # At most PARTS phrases have as large a share.
        share, hot = max(words // PARTS, 1), {}
        for name, prefix, f in level.where((F.col("f") > share) & F.col("next").isNotNull()).select("lang", _phrase(), "f").toLocalIterator():
            hot.setdefault(name, {})[bytes(prefix)] = -(-f // share)
    return levels


def _phrase() -> Column:
    """The phrase of a row of a level."""
    space = F.lit(b" ")
    return F.when(F.octet_length("prefix") == 0, F.col("next")).otherwise(F.concat("prefix", space, "next")).alias("phrase")


def _scores(levels: list[DataFrame], scale: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the frequent phrases of two words or more, by their lowest cut."""
    known = levels[0].select("lang", _phrase(), "f").where("phrase is not null")
    for level in levels[1:]:
        known = known.unionByName(level.select("lang", _phrase(), "f"))
    parts = None
    for size, level in enumerate(levels[1:], 2):
        words = F.split(_phrase().cast("string"), " ")

        def side(start: int, n: int, words: Column = words) -> Column:
            return F.array_join(F.slice(words, start, n), " ").cast("binary")

        cuts = []
        for k in range(1, size):
            left = F.col("prefix") if k == size - 1 else side(1, k)
            right = F.col("suffix") if k == 1 else F.col("next") if k == size - 1 else side(k + 1, size - k)
            cuts += [F.struct(F.lit(k).alias("cut"), F.lit(s).alias("side"), p.alias("part")) for s, p in ((0, left), (1, right))]
        one = level.select("lang", _phrase(), F.col("f").alias("a"), F.explode(F.array(*cuts)).alias("x"))
        one = one.select("lang", "phrase", "a", "x.*")
        parts = one if parts is None else parts.unionByName(one)
    found = parts.join(known.withColumnRenamed("phrase", "part"), ["lang", "part"])
    n_cuts = len(levels) - 1
    sums = [
        F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("f"))).alias(f"{'lr'[s]}{k}")
        for k in range(1, n_cuts + 1) for s in (0, 1)
    ]
    sums = found.groupBy("lang", "phrase", "a").agg(*sums)
    wide = "decimal(38,0)"
    scored = [
        F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(
                F.expr(f"cast({scale} * cast(a as {wide}) div (cast(l{k} as {wide}) + cast(r{k} as {wide})) as long)").alias("score"),
                F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
            ),
        )
        for k in range(1, n_cuts + 1)
    ]
    lowest = F.array_min(F.array_compact(F.array(*scored)))
    return sums.select("lang", "phrase", "a", lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, top: int | None = 2000, scale: int = 2_000_000, subsumed: int = 80,
    lang: str = "lang", text: str = "text", bits: int = FILTER_BITS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's first ``top`` phrases (None: all).

    Words are runs of characters other than space and tab in the pieces between
    ``. , ; : ! ?`` and line ends, A-Z in lower case. A phrase has 2 to ``longest``
    words of one piece and occurs ``a`` >= ``least`` times; its score is the lowest
    ``scale * a div (l + r)`` over its cuts into two parts of l and r occurrences.
    A phrase goes if a phrase with one word more, before or after it, has at least
    ``subsumed`` per cent of its occurrences. (A still longer one then has a part of
    one word more that is as frequent.) ``n`` counts the language's words. Order: score, ``a``, both
    falling, then the bytes of the phrase.

    Texts are read once for each length of a phrase, and only phrases that can be
    frequent are counted and shuffled. Beyond some 2^``bits`` / 4 frequent phrases
    the map fills up: results stay the same, more rare phrases are counted.

    A null language is ``und``, like the text ``und``; a null or empty text has no
    words. Repeated rows count each time. An empty table gives an empty result.
    Other columns are ignored, whatever their names.
    """
    path = new_shared_path(docs.sparkSession, "collocations")
    levels = phrase_levels(docs, path, least, longest, bits, lang, text)
    words = levels[0].where("next is null").groupBy("lang").agg(F.sum("f").alias("n"))
    longer = None
    for level in levels[2:]:
        for shorter in ("prefix", "suffix"):
            one = level.select("lang", F.col(shorter).alias("phrase"), "f")
            longer = one if longer is None else longer.unionByName(one)
    df = _scores(levels, scale)
    if longer is not None:
        most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        df = df.join(most, ["lang", "phrase"], "left")
        wide = "decimal(38,0)"
        df = df.where(F.expr(f"most is null or 100 * cast(most as {wide}) < {subsumed} * cast(a as {wide})"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # The first of each part of a language, then of their first.
        part = F.pmod(F.xxhash64("phrase"), F.lit(256))
        df = df.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        df = df.where(F.col("place") <= top)
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        df = df.where(F.col("rank") <= top)
    return df.join(words, "lang").select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
