"""Spelling variants: words one edit apart, found by dense comparison of prefixes and suffixes in tiles of padded matrices."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import query, table
from keyscore.storage import materialize

#: Maximal runs of letters; only A-Z is lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a block, and code points that one comparison of tiles may hold.
TILE, CELLS = 256, 1 << 22
#: From this many words on, a group is divided by what else its pairs must share.
LARGE = 2048


def noisy_words(docs: DataFrame, shortest: int = 7, every: int = 31) -> DataFrame:
    """``word`` of each run of at least ``shortest`` letters, with a code point deleted where a hash of id and word says so.

    A shorter run cannot give a word of that length, so the pattern leaves it out.
    """
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{shortest},}})"), 1))
    words = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    words = words.select("id", F.translate("run", UPPER, LOWERED).alias("run"))
    words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return words.select(word.alias("word")).where(F.length("word") >= shortest)


def _cuts(n: Column) -> list[tuple[Column, Column]]:
    """How many code points the pairs of a key share at either end, where the longer word has ``n``.

    Two words one edit apart share a prefix of p and a suffix of n - 1 - p code points at least. With cuts at a third
    and two thirds, p says which key finds them: the last one whose prefix is not longer than p.
    """
    a, b = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
    zero = F.lit(0)
    return [(zero, n - a), (a, n - b), (b, zero)]


def block_keys(words: DataFrame) -> DataFrame:
    """Six keys for each word: as long as the longer word of a pair or one shorter, for each cut."""
    size = F.length("word")
    keys = []
    for extra in (0, 1):
        n = size + extra
        for cut, (front, back) in enumerate(_cuts(n)):
            shared = F.concat(F.substring("word", F.lit(1), front), F.lit(" "), F.when(back > 0, F.substring("word", size - back + 1, back)).otherwise(F.lit("")))
            keys.append(F.struct(n.alias("longer"), F.lit(cut).alias("cut"), front.alias("front"), back.alias("back"), F.xxhash64(n, F.lit(cut), shared).alias("key")))
    rows = words.select("word", "n", F.explode(F.array(*keys)).alias("x"))
    return rows.select("word", "n", "x.longer", "x.cut", "x.front", "x.back", "x.key").where(F.col("front") + F.col("back") <= F.length("word"))


def divided(rows: DataFrame, large: int = LARGE) -> DataFrame:
    """Words by group, where groups of ``large`` words and more give way to narrower ones.

    Where the shared prefix of a pair ends is one of the places between the group's cuts. A narrower group is for one
    such place: its words agree on all code points before it and all behind the edit. So it has no more words than
    there are letters, and each word is in a group for each place.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
    hot = sizes.where(F.col("size") >= large).select("key", F.lit(True).alias("hot"))
    marked = rows.join(hot, "key", "left")
    usual = marked.where(F.col("hot").isNull()).select("word", "n", "longer", F.col("front").alias("least"), (F.col("longer") - F.col("back") - 1).alias("most"), "key")
    places = F.explode(F.sequence(F.col("front"), F.col("longer") - F.col("back") - 1))
    size, back = F.length("word"), F.col("longer") - 1 - F.col("place")
    narrow = marked.where(F.col("hot")).select("word", "n", "longer", "cut", places.alias("place"))
    rest = F.when(back > 0, F.substring("word", size - back + 1, back)).otherwise(F.lit(""))
    key = F.xxhash64("longer", F.lit(-1), "place", F.concat(F.substring("word", F.lit(1), F.col("place")), F.lit(" "), rest))
    narrow = narrow.select("word", "n", "longer", F.col("place").alias("least"), F.col("place").alias("most"), key.alias("key"))
    return usual.unionByName(narrow)


def code_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words from the left and from the right, padded to the longest, and the lengths."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint8 if codes.max() < 256 else np.uint32)
    there = np.arange(width) < lengths[:, None]
    left = np.zeros((len(words), width), codes.dtype)
    left[there] = codes
    right = np.zeros_like(left)
    right[there[:, ::-1]] = codes
    return left, right[:, ::-1], lengths


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading entries each row of a block shares with each of the other block, for many pairs of blocks."""
    differ = a[:, :, None, :] != b[:, None, :, :]
    first = differ.argmax(axis=3)
    return np.where(differ.any(axis=3), first, a.shape[-1])


def compare(a: tuple, b: tuple, longer: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which pairs of two stacks of tiles are one edit apart, where the longer word has ``longer`` code points.

    ``least`` and ``most`` bound the common prefix: every pair belongs to one group that way.
    """
    (left, right, size), (left_b, right_b, size_b) = a, b
    top = np.maximum(size[:, :, None], size_b[:, None, :])
    short = np.minimum(size[:, :, None], size_b[:, None, :])
    prefix = np.minimum(common(left, left_b), short)
    suffix = np.minimum(common(right, right_b), short)
    # equal words and padding are no pairs
    near = (prefix + suffix >= top - 1) & (prefix < top) & (short > 0) & (top - short <= 1)
    place = np.minimum(prefix, top - 1)
    each = (slice(None), None, None)
    return near & (top == longer[each]) & (place >= least[each]) & (place <= most[each])


def tiles(sizes: np.ndarray, heads: np.ndarray, longer: np.ndarray) -> dict[int, np.ndarray]:
    """Pairs of blocks (first row and rows of each) by the size of a block.

    A small group is one block that meets itself. Blocks are smaller where words are long, so that a comparison of two
    stays within ``CELLS`` or is one of two words.
    """
    most = np.minimum(TILE, 2 ** np.floor(np.log2(np.maximum(CELLS // longer[heads], 1)) / 2).astype(np.int64))
    out: dict[int, list[np.ndarray]] = {}
    small = (sizes > 1) & (sizes <= most)
    steps = 2 ** np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    for step in np.unique(steps[small]).tolist():
        h, s = (x[small & (steps == step)] for x in (heads, sizes))
        out.setdefault(step, []).append(np.stack((h, s, h, s), axis=1))
    for g in np.flatnonzero(sizes > most).tolist():
        starts = np.arange(heads[g], heads[g] + sizes[g], most[g])
        rows = np.minimum(most[g], heads[g] + sizes[g] - starts)
        i, j = np.triu_indices(len(starts))
        out.setdefault(int(most[g]), []).append(np.stack((starts[i], rows[i], starts[j], rows[j]), axis=1))
    return {step: np.concatenate(x) for step, x in out.items()}


def near_in_groups(words: list[str], group: np.ndarray, longer: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple]:
    """Pairs of rows i < j one edit apart in each group; rows come sorted by group.

    Pairs of blocks of one size are stacked, so that one comparison takes many small groups or some of a large one's.
    """
    heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(heads, len(group)))
    for step, pairs in tiles(sizes, heads, longer).items():
        # long words last, so that they do not widen the matrices of others
        pairs = pairs[np.argsort(longer[pairs[:, 0]], kind="stable")]
        start = 0
        while start < len(pairs):
            width = int(longer[pairs[start, 0]])
            stop = start + max(1, CELLS // (2 * step * step * width))
            stop = start + int(np.searchsorted(longer[pairs[start:stop, 0]], 2 * width, side="right"))
            part = pairs[start:stop]
            rows = [part[:, k, None] + np.minimum(np.arange(step), part[:, k + 1, None] - 1) for k in (0, 2)]
            real = [np.arange(step) < part[:, k + 1, None] for k in (0, 2)]
            used, at = np.unique(np.stack(rows), return_inverse=True)
            left, right, lengths = code_matrix([words[i] for i in used.tolist()])
            a, b = ((left[x], right[x], np.where(ok, lengths[x], 0)) for x, ok in zip(at.reshape(2, *rows[0].shape), real))
            head = part[:, 0]
            t, i, j = np.nonzero(compare(a, b, longer[head], least[head], most[head]))
            first, second = rows[0][t, i], rows[1][t, j]
            once = first < second
            yield first[once], second[once]
            start = stop


def _near(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[pa.RecordBatch]:
    """For each word of some groups: how many near words they hold, and the largest of those."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        found = [np.empty((2, 0), np.int64)]
        for i, j in near_in_groups(words, table["key"].to_numpy(), *(table[c].to_numpy() for c in ("longer", "least", "most"))):
            found += [np.stack((i, j)), np.stack((j, i))]
        word, other = np.concatenate(found, axis=1)
        names = np.array(words, object)
        return pa.RecordBatch.from_arrays([pa.array(names[word], pa.string()), pa.array(n[other]), pa.array(names[other], pa.string())], ["word", "near_n", "near"])

    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        # what is held is compared up to the last group that has ended
        if (rows + len(keys) >= together or size + batch.nbytes >= 320 * together) and (ends := np.flatnonzero(keys[1:] != keys[:-1]) + 1).size:
            held.append(batch.slice(0, int(ends[-1])))
            yield compared(pa.Table.from_batches(held))
            held, rows, size = [], 0, 0
            batch = batch.slice(int(ends[-1]))
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
    if held:
        yield compared(pa.Table.from_batches(held))


def near_words(words: DataFrame, large: int = LARGE, together: int = 100_000) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for every pair of words one edit apart, both ways and once each.

    ``words`` has distinct words and a number ``n`` each.
    """
    spark = words.sparkSession
    rows = materialize(block_keys(words), "spelling-keys")
    groups = divided(rows, large)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_groups = groups.repartition(max(parts, -(-rows.count() // 500_000)), "key").sortWithinPartitions("key")
    return sorted_groups.mapInArrow(lambda batches: _near(batches, together), "word string, near_n long, near string")


def group_variants(words: DataFrame, times: int = 10, large: int = LARGE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for each of the distinct ``words`` (``word``, ``n``).

    A word's form is the near word of the largest n, the first in code-point order among equals, if that n is at least
    ``times`` its own; its root is the last one reached by following forms. Words without a near word are their own
    root. An empty table gives no rows; null words are left out; words of any length and script are compared whole.

    A form has ``times`` the n of its word, so a chain is no longer than the logarithm of the largest n, and following
    every other link halves it.
    """
    words = words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n"))
    words = materialize(words, "spelling-words")
    pairs = near_words(words.where(F.length("word") > 0), large)
    # ties: the first in code-point order, which is the byte order of UTF-8
    largest = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near"))).alias("x")
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), largest)
    joined = words.join(near, "word", "left")
    is_form = -F.col("x.minus_n") >= times * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("x.near")).alias("form"), F.when(is_form, -F.col("x.minus_n")).alias("form_n")
    )
    joined = materialize(joined, "spelling-forms")
    links = joined.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = joined.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.ceil(math.log(max(most, 2), max(times, 2))))
    for _ in range(max(0, math.ceil(math.log2(longest)))):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    out = joined.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_in(docs: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """Spelling variants among the words of all texts of ``docs`` that occur ``least`` times.

    Null and empty texts have no words, a null id counts as an empty one, repeated rows count each time, and columns
    other than ``doc_id`` and ``text`` are not read.
    """
    counts = noisy_words(docs.select("doc_id", "text"), shortest).groupBy("word").agg(F.count("*").alias("n"))
    return group_variants(counts.where(F.col("n") >= least))


SQL_SPELLING = """
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT run, hex(encode(doc_id || ':' || run)) AS h, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT))),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS crc
  FROM counted, crc
), noisy AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[1 : crc % len(run)] || run[crc % len(run) + 2 : len(run)] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, word[1 : i - 1] || '×' || word[i + 1 : len(word)] AS replaced, word[1 : i - 1] || word[i + 1 : len(word)] AS deleted
  FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.replaced = b.replaced AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.deleted
  UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.deleted
), near AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), chains(word, root, depth) AS (
  SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, depth + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, depth) AS root FROM chains GROUP BY word
)
SELECT f.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms f JOIN roots USING (word)
"""


@query("op11_spelling_variants", SQL_SPELLING)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants_in(table(spark, sf_dir, "documents"))
