"""Collocations: phrases counted by an FM-index over word ids in every shard, and their scores from the summed counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyscore.llm.common import BASE, LOWER, chunks, flat_bytes, mix, query, table, word_spans
from keyscore.storage import materialize

#: What ends a piece, and what separates words: that, a blank or a tab.
ENDS = ".,;:!?\n\x0b\x0c\r"
IS_END = np.zeros(256, bool)
IS_END[list(ENDS.encode())] = True
IS_GAP = IS_END.copy()
IS_GAP[list(b" \t")] = True

#: Words of a shard's index; a shard that keeps the spelling of all its words has half as many.
SHARD_WORDS = 1_000_000
#: Bits of a filter for each thing that it lets pass, and the bits of the smallest and largest filter as powers of two.
FILTER_BITS, SMALLEST, LARGEST = 16, 18, 28
#: Languages whose totals are sent to every task; more are joined.
FEW_LANGS = 10_000
#: Columns of a phrase's words are counted in decimals, as products pass 64 bits.
WIDE = "decimal(38,0)"


class ShardIndex:
    """An FM-index of a sequence of ids and one of its reverse; 0 ends a piece and stands at both ends.

    Suffixes are sorted by their first ``depth`` ids, which is all that ranges of phrases of up to that length need. A
    phrase is a range of equal size in either index. Extending it to the left by an id c makes it c's part of the
    range's column of preceding ids (the BWT), which in that index is found by rank; in the other index it is the part
    of the phrase's range behind those of smaller ids. Extending to the right is the same with the indexes exchanged.
    All phrases of one length are extended at once.
    """

    def __init__(self, ids: np.ndarray, depth: int):
        self.bwt, self.ranked = [], []
        width = int(ids.max(initial=1)).bit_length()
        held = 63 // width
        for text in (ids, ids[::-1]):
            padded = np.concatenate((text, np.zeros(depth, np.int64)))
            keys = []
            for start in range(0, depth, held):
                key = np.zeros(len(text), np.int64)
                for k in range(start, min(start + held, depth)):
                    key = (key << width) | padded[k : k + len(text)]
                keys.append(key)
            order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
            del keys, padded
            bwt = text[order - 1].astype(np.int32)
            del order
            self.bwt.append(bwt)
            # place j of the index is reached from row ranked[j]: rows by preceding id, then by place
            self.ranked.append(np.argsort(bwt, kind="stable").astype(np.int32))
        counts = np.bincount(ids)
        counts[0] = 0
        first = np.concatenate(([0], np.cumsum(counts)))[:-1] + np.count_nonzero(ids == 0)
        there = np.flatnonzero(counts)
        self.grams, self.size = there[:, None], counts[there]
        self.low = [first[there], first[there].copy()]

    def extend(self, side: int) -> None:
        """From all phrases of a length to all that have one more word on the left (side 0) or the right (1)."""
        bwt, ranked, low = self.bwt[side], self.ranked[side], self.low[side]
        by_low = np.argsort(low)
        sizes = self.size[by_low]
        total = int(sizes.sum())
        rows = np.arange(total) + np.repeat(low[by_low] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        phrase = np.full(len(bwt), -1, np.int32)
        phrase[rows] = np.repeat(by_low.astype(np.int32), sizes)
        del rows
        of, word = phrase[ranked], bwt[ranked]
        place = np.flatnonzero((of >= 0) & (word > 0))
        of, word = of[place], word[place]
        new = np.flatnonzero(np.concatenate(([len(of) > 0], (of[1:] != of[:-1]) | (word[1:] != word[:-1])))[: len(of)])
        size = np.diff(np.append(new, len(of)))
        low, of, word = place[new], of[new], word[new]
        # in the other index: behind the ends of pieces and the parts of smaller words
        order = np.lexsort((word, of))
        sizes, parents = size[order], of[order]
        before = np.cumsum(sizes) - sizes
        heads = np.flatnonzero(np.concatenate(([len(parents) > 0], parents[1:] != parents[:-1]))[: len(parents)])
        before -= np.repeat(before[heads], np.diff(np.append(heads, len(parents))))
        ends = self.size - np.bincount(parents, weights=sizes, minlength=len(self.size)).astype(np.int64)
        other = np.empty_like(low)
        other[order] = self.low[1 - side][parents] + ends[parents] + before
        self.low[side], self.low[1 - side] = low, other
        self.size = size
        column, grams = word[:, None], self.grams[of]
        self.grams = np.hstack((column, grams) if side == 0 else (grams, column))


class Filter:
    """A bit for each hash; what was put in passes, and little else."""

    def __init__(self, bits: int, rows: list):
        self.shift = np.uint64(64 - bits)
        self.bytes = np.zeros(1 << bits >> 3, np.uint8)
        for bucket, bitmap in rows:
            start = (bucket - 1) * 4096
            part = np.frombuffer(bitmap, np.uint8)[: len(self.bytes) - start]
            self.bytes[start : start + len(part)] = part

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> self.shift).astype(np.int64)
        return (self.bytes[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def filter_of(hashes: DataFrame, column: str) -> Filter:
    """Which hashes occur. A filter has at most 2**LARGEST bits; beyond that it lets more pass, and still all that it must."""
    n = hashes.count()
    bits = min(LARGEST, max(SMALLEST, (FILTER_BITS * n).bit_length()))
    slot = F.shiftrightunsigned(column, 64 - bits) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    return Filter(bits, [(r.bucket, bytes(r.bits)) for r in rows.collect()])


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its words but the last, and the last one's."""
    return mix(a * np.uint64(BASE) + b)


def salt(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def of_language(hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    hashes = mix(hashes ^ salts)
    hashes[hashes == 0] = 1
    return hashes


#: Lets no word pass.
NOTHING = Filter(SMALLEST, [])


class Shard:
    """Words of some texts, as hashes of language and word; 0 stands between pieces."""

    def __init__(self):
        self.langs: list[str] = []
        self.lang_codes: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.hashes: list[np.ndarray] = [np.zeros(1, np.uint64)]
        self.names: dict[int, tuple[str, str]] = {}
        self.words = 0

    def add(self, part: pa.RecordBatch, named: Filter | None) -> None:
        """The words of some rows; the spelling of those that ``named`` lets pass is kept, of all without it."""
        flat, offsets = flat_bytes(part.column("text"))
        hashes, first, last = word_spans(flat, offsets, IS_GAP)
        if not len(hashes):
            return
        row = np.searchsorted(offsets, first, side="right") - 1
        codes = []
        for lang in part.column("lang").to_pylist():
            if lang not in self.lang_codes:
                self.lang_codes[lang] = len(self.langs)
                self.langs.append(lang)
            codes.append(self.lang_codes[lang])
        salts = np.array([salt(lang) for lang in self.langs], np.uint64)
        lang = np.array(codes, np.int32)[row]
        hashes = of_language(hashes, salts[lang])
        piece = np.searchsorted(np.flatnonzero(IS_END[flat]), first)
        new = np.flatnonzero((row[1:] != row[:-1]) | (piece[1:] != piece[:-1])) + 1
        self.hashes += [np.insert(hashes, new, 0), np.zeros(1, np.uint64)]
        self.words += len(hashes)
        known = np.arange(len(hashes)) if named is None else np.flatnonzero(named(hashes))
        unique, at = np.unique(hashes[known], return_index=True)
        lower = LOWER[flat].tobytes() if named is None else None
        for h, i in zip(unique.tolist(), known[at].tolist()):
            if h not in self.names:
                word = lower[first[i] : last[i] + 1] if lower else LOWER[flat[first[i] : last[i] + 1]].tobytes()
                self.names[h] = self.langs[lang[i]], word.decode("utf-8", "replace")

    def sequence(self) -> np.ndarray:
        return np.concatenate(self.hashes)

    def spelled(self, unique: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages and spellings of the words with these hashes; none for 0."""
        found = [self.names.get(h, ("", "")) for h in unique.tolist()]
        out = np.empty((2, len(found)), object)
        out[0], out[1] = [x[0] for x in found], [x[1] for x in found]
        return out[0], out[1]


def shards(batches: Iterator[pa.RecordBatch], named: Filter | None, most: int) -> Iterator[Shard]:
    shard = Shard()
    for batch in batches:
        for start, stop in chunks(batch.column("text")):
            shard.add(batch.slice(start, stop - start), named)
            if shard.words >= most:
                yield shard
                shard.clear()
    if shard.words:
        yield shard


def segments(hashes: np.ndarray, words: Filter, pairs: Filter | None = None, triples: Filter | None = None) -> np.ndarray:
    """The sequence cut so that no phrase in it holds a word, pair or triple that does not pass.

    0 stands for words that do not pass and between pairs that do not. Where the triple a b c does not pass, b ends one
    segment and begins the next: a b 0 b c. Each phrase of two words and more is as often in the result as before, if
    all its parts pass. Words alone are left out, and of several 0 all but one.
    """
    hashes = np.where((hashes != 0) & words(hashes), hashes, np.uint64(0))
    if pairs is not None:
        at = np.flatnonzero((hashes[:-1] != 0) & (hashes[1:] != 0))
        hashes = np.insert(hashes, at[~pairs(joined_hash(hashes[at], hashes[at + 1]))] + 1, np.uint64(0))
    full = np.concatenate(([False], hashes != 0, [False]))
    alone = full[1:-1] & ~full[:-2] & ~full[2:]
    hashes = np.where(alone, np.uint64(0), hashes)
    hashes = hashes[(hashes != 0) | np.concatenate(([True], hashes[:-1] != 0))]
    if triples is not None:
        at = np.flatnonzero((hashes[:-2] != 0) & (hashes[1:-1] != 0) & (hashes[2:] != 0))
        at = at[~triples(joined_hash(joined_hash(hashes[at], hashes[at + 1]), hashes[at + 2]))]
        twice = np.stack((np.zeros(len(at), np.uint64), hashes[at + 1]), axis=1).ravel()
        hashes = np.insert(hashes, np.repeat(at + 2, 2), twice)
    return hashes


def dense(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids from 1 in the order of the hashes, 0 staying 0; and the hash of each id."""
    unique, ids = np.unique(np.append(hashes, np.uint64(0)), return_inverse=True)
    return ids[:-1].astype(np.int64), unique


def count_words(docs: DataFrame, most: int) -> DataFrame:
    """``lang``, ``phrase`` (a word) and ``n``, per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, None, most):
            unique, n = np.unique(shard.sequence(), return_counts=True)
            langs, words = shard.spelled(unique[there := unique != 0])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n[there])], ["lang", "phrase", "n"])

    return docs.mapInArrow(run, "lang string, phrase string, n long")


def hash_words(words: DataFrame) -> DataFrame:
    """``hash`` of each ``lang`` and ``phrase`` of one word, as shards have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _, _ = word_spans(*flat_bytes(batch.column("phrase")), IS_GAP)
            salts = np.array([salt(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(of_language(hashes, salts).view(np.int64))], ["hash"])

    return words.select("lang", "phrase").mapInArrow(run, "hash long")


def count_hashed(docs: DataFrame, length: int, filters: list, most: int) -> DataFrame:
    """``hash`` and ``n``, per shard, of phrases of 2 or 3 words whose words and pairs pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, NOTHING, most):
            ids, hashes = dense(segments(shard.sequence(), *(f.value for f in filters)))
            index = ShardIndex(ids, length)
            for k in range(1, length):
                index.extend(k % 2)
            phrase = hashes[index.grams[:, 0]]
            for k in range(1, length):
                phrase = joined_hash(phrase, hashes[index.grams[:, k]])
            yield pa.RecordBatch.from_arrays([pa.array(phrase.view(np.int64)), pa.array(index.size)], ["hash", "n"])

    return docs.mapInArrow(run, "hash long, n long")


def count_phrases(docs: DataFrame, filters: list, longest: int, most: int) -> DataFrame:
    """``lang``, ``phrase`` and ``n``, per shard, of phrases of 2 to ``longest`` words all of whose parts pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = [f.value for f in filters]
        for shard in shards(batches, passed[0], most):
            ids, unique = dense(segments(shard.sequence(), *passed))
            langs, words = shard.spelled(unique)
            index = ShardIndex(ids, longest)
            for length in range(2, longest + 1):
                index.extend(length % 2)
                for at in range(0, len(index.size), 100_000):
                    grams = index.grams[at : at + 100_000].T
                    phrases = list(map(" ".join, zip(*(words[g] for g in grams))))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(langs[grams[0]], pa.string()), pa.array(phrases, pa.string()), pa.array(index.size[at : at + 100_000])],
                        ["lang", "phrase", "n"],
                    )

    return docs.mapInArrow(run, "lang string, phrase string, n long")


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, best: int = 2000, cover: int = 100, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Words are lower-cased (A-Z) and lie within pieces that punctuation and line ends bound. A phrase that occurs ``a``
    times, ``least`` at least, is cut where floor(1000 * a * n / (l * r)) is least (ties: the earliest cut), l and r
    being the counts of its two parts and n all words of the language; those with a longer candidate around them that
    occurs in ``cover`` percent of their occurrences are left out. ``n_left`` and ``n_right`` say by how many different
    words a phrase can be extended to a candidate. A null text is empty and a null language ``und``; repeated rows and
    ids count each time; texts of any length are counted whole, and columns beside ``text`` and ``lang`` are not read.
    An empty table, or one without frequent phrases, gives no rows.

    A phrase cannot be frequent unless its parts are. So shards count words first, then pairs of frequent words, triples
    of frequent pairs, and phrases of frequent triples; hashed filters of a bounded size carry what is frequent, and
    pass too much at worst. The counts that are returned are those of whole phrases, by their text.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = materialize(count_words(texts, max(1, shard_words // 2)).groupBy("lang", "phrase").agg(F.sum("n").alias("a")), "collocation-words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    words = words.where(F.col("a") >= least)
    filters = [spark.sparkContext.broadcast(filter_of(materialize(hash_words(words), "collocation-filter"), "hash"))]
    for length in range(2, min(longest, 4)):
        counted = count_hashed(texts, length, filters, shard_words).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        filters.append(spark.sparkContext.broadcast(filter_of(materialize(counted.select("hash"), "collocation-filter"), "hash")))
    counted = count_phrases(texts, filters, longest, shard_words).groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
    phrases = materialize(words.unionByName(counted.where(F.col("a") >= least)), "collocation-phrases")
    return _scored(phrases, totals, longest, best, cover)


def _scored(phrases: DataFrame, totals: DataFrame, longest: int, best: int, cover: int) -> DataFrame:
    split = phrases.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words"))
    candidates = split.where(F.col("size") >= 2)
    joined = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = candidates.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(1, F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    # an occurrence of a longer phrase is one of the phrases one word shorter in it, so those decide for all longer ones
    longer = candidates.where(F.col("size") >= 3)
    part = lambda start, left: F.struct(joined(start, F.col("size") - 1).alias("phrase"), F.lit(left).alias("left"))
    inner = longer.select("lang", F.explode(F.array(part(2, 1), part(1, 0))).alias("x"), "a")
    inner = inner.groupBy("lang", "x.phrase").agg(F.max("a").alias("around"), F.sum("x.left").alias("n_left"), F.sum(1 - F.col("x.left")).alias("n_right"))
    free = candidates.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (cover * F.col("a") > 100 * F.col("around")))
    free = free.select("lang", "phrase", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_left", "n_right")))
    if totals.count() <= FEW_LANGS:
        totals = F.broadcast(totals)
    cuts = cuts.join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(20,0)").cast(WIDE)
    cuts = cuts.withColumns({"above": F.lit(1000).cast(WIDE) * wide("a") * wide("n"), "below": wide("l") * wide("r")})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    least = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
    scored = least.join(free, ["lang", "phrase"]).select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score", "n_left", "n_right")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")


SQL_COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM words)
), phrases AS (
  SELECT lang, m, w[i : i + m - 1] AS w, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, w, a, unnest(range(1, m)) AS k FROM phrases WHERE m >= 2
), scores AS (
  SELECT c.lang, c.w, c.m, c.a, c.k, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.w = c.w[1 : k] JOIN phrases y ON y.lang = c.lang AND y.w = c.w[k + 1 : c.m]
  JOIN totals t ON t.lang = c.lang
), cut AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, w[2 : m] AS w, a, 1 AS on_left FROM phrases WHERE m >= 3
  UNION ALL SELECT lang, w[1 : m - 1], a, 0 FROM phrases WHERE m >= 3
), around AS (
  SELECT lang, w, max(a) AS a, sum(on_left) AS n_left, sum(1 - on_left) AS n_right FROM inner_phrases GROUP BY ALL
), free AS (
  SELECT c.*, coalesce(o.n_left, 0) AS n_left, coalesce(o.n_right, 0) AS n_right
  FROM cut c LEFT JOIN around o ON o.lang = c.lang AND o.w = c.w WHERE o.a IS NULL OR o.a < c.a
), named AS (
  SELECT *, array_to_string(w, ' ') AS phrase FROM free
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
  CAST(score AS BIGINT) AS score, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right
FROM ranked WHERE rank <= 2000
"""


@query("op12_collocations", SQL_COLLOCATIONS)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
