"""Spelling variants: words that differ in one letter, by an index of grams of variable length.

The dictionary holds the frequent grams. A word's gram at a place grows letter by letter while it is in the
dictionary, up to a level's longest size, so common beginnings make long, rarer grams; grams inside
earlier ones are left out. One replaced or deleted letter spoils only the grams that hold it and those on its right that
a new longer gram may swallow, which the endings of the dictionary tell. With at most b of a word's grams
spoiled at any place, each of its variants shares one of any b + 1 of them, at its place or one to the left: the
word looks through the lists of its b + 1 rarest grams only, and what stands there is compared in full.
Every word is indexed at every level in use and asks at the level where its lists are shortest.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surelake import session
from surelake.llm.common import coded, list_lengths, shuffle_partitions, small_batches, text_of

#: What words consist of.
LETTERS = "A-Za-zÀ-ÿ"
#: Longest gram of each level. At the first, all grams are pairs, and every word of five letters or more keeps two of them.
LEVELS = (2, 3, 4, 6)
#: Pairs compared at once, in letters.
BLOCK = 1 << 22


# Words

@cache
def shift_table(n: int) -> np.ndarray:
    """What ``n`` more bytes make of each byte of a CRC-32."""
    zeros = bytes(n)
    none = zlib.crc32(zeros)
    return np.array([[zlib.crc32(zeros, b << 8 * k) ^ none for b in range(256)] for k in range(4)], np.uint32)


def checksums(before: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of a beginning followed by a word, from both checksums and the word's bytes."""
    out = words.copy()
    for n in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == n)
        table = shift_table(n) if n <= 256 else None
        if table is None:
            zeros, none = bytes(n), zlib.crc32(bytes(n))
            out[own] ^= np.array([zlib.crc32(zeros, int(b)) ^ none for b in before[own]], np.uint32)
        else:
            for k in range(4):
                out[own] ^= table[k][before[own] >> np.uint32(8 * k) & np.uint32(255)]
    return out


def letters_only(texts: pa.Array) -> pa.Array:
    """Texts without nulls, every byte outside ``LETTERS`` a space and A-Z in lower case. À to ÿ are the byte C3 and one more."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    lower = np.full(256, ord(" "), np.uint8)
    for c in range(ord("a"), ord("z") + 1):
        lower[[c, c - 32]] = c
    out = lower[raw]
    lead = np.flatnonzero(raw == 0xC3)
    out[lead], out[lead + 1] = 0xC3, raw[lead + 1]
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(out))


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = 5, misspell: int = 0, most_held: int = 400_000) -> DataFrame:
    """(word, n): runs of ``LETTERS`` of whole texts, A-Z in lower case, of at least ``least_letters`` code points, with their counts.

    With ``misspell`` m, a run whose CRC-32 h of ``<doc_id>:<run>`` m divides loses its code point h % length, and what is
    left counts as the word; a null id is read as ``null``. Null and empty texts have no words, a run of any length is one word.
    An empty table gives no rows; other columns are not read. A task holds ``most_held`` words at a time.
    """
    given = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in small_batches(batches, "text", 8 << 20):
            parts = pc.ascii_split_whitespace(letters_only(batch.column("text")))
            found = parts.flatten().dictionary_encode()
            words = found.dictionary.to_pylist()
            at = found.indices.to_numpy(zero_copy_only=False)
            counts = np.bincount(at, minlength=len(words))
            if misspell:
                before = np.array([zlib.crc32(f"{'null' if d is None else d}:".encode()) for d in batch.column("doc_id").to_pylist()], np.uint32)
                raws = [w.encode() for w in words]
                own = np.array([zlib.crc32(r) for r in raws], np.uint32)
                sizes = np.array([len(r) for r in raws], np.int64)
                h = checksums(np.repeat(before, list_lengths(parts)), own[at], sizes[at])
                hit = np.flatnonzero((h % np.uint32(misspell) == 0) & (sizes[at] > 0))
                counts -= np.bincount(at[hit], minlength=len(words))
                for k, drop in zip(at[hit].tolist(), h[hit].tolist()):
                    w = words[k]
                    drop %= len(w)
                    if len(w) > least_letters:
                        held[w[:drop] + w[drop + 1 :]] += 1
            for w, n in zip(words, counts.tolist()):
                if n and len(w) >= least_letters:
                    held[w] += n
            if len(held) > most_held:
                yield told(held)
                held.clear()
        yield told(held)

    def told(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# Grams

class Grams:
    """Frequent grams with their counts; a gram's beginnings are as frequent, so the dictionary holds them too."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        #: Endings, not whole, of the frequent grams shorter than each level.
        self.endings = {q: {g[k:] for g in counts if len(g) < q for k in range(1, len(g))} for q in LEVELS}

    def cut(self, word: str, longest: int) -> list[tuple[int, int]]:
        """(start, end) of the word's grams at a level, from left to right."""
        out, reach, n = [], 0, len(word)
        for p in range(n - 1):
            e = p + 2
            while e - p < longest and e < n and word[p:e] in self.counts:
                e += 1
            if e > reach:
                out.append((p, e))
                reach = e
        return out

    def spoiled(self, word: str, grams: list[tuple[int, int]], longest: int) -> int:
        """How many of its grams at most one replaced or deleted letter can spoil."""
        ends = self.endings[longest]
        most = 0
        for i in range(len(word)):
            n = 0
            for p, e in grams:
                if e > i:
                    if p > i and word[i + 1 : e - 1] not in ends:
                        break  # nor are those further right
                    n += 1
            most = max(most, n)
        return most

    def asks(self, word: str, rare: int, cuts: dict[int, list[tuple[int, int]]]) -> tuple[int, list[tuple[int, int]]]:
        """(level, grams whose lists hold all variants), a level of the shortest lists. ``cuts``: the word's grams at each level."""
        best = None
        for q in reversed(LEVELS):  # the higher, the shorter the lists
            if q > 2 and 2 * q > len(word):
                continue
            grams = cuts[q]
            sizes = sorted((self.counts.get(word[p:e], rare), p, e) for p, e in grams)
            if best is not None and sum(s[0] for s in sizes[:2]) >= best[0]:  # an edit spoils one at least
                continue
            n = self.spoiled(word, grams, q) + 1
            if n <= len(grams):
                cost = sum(s[0] for s in sizes[:n])
                if best is None or cost < best[0]:
                    best = cost, q, [(p, e) for _, p, e in sizes[:n]]
        return best[1:]


def frequent_grams(words: DataFrame, least: int, most: int) -> dict[str, int]:
    """Grams shorter than the highest level found at more than ``least`` places of all words, at most the ``most`` frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter = Counter()
            for w in batch.column("word").to_pylist():
                for q in range(2, LEVELS[-1]):
                    held.update([w[p : p + q] for p in range(len(w) - q + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["gram", "n"])

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    return {r.gram: r.n for r in found.orderBy(F.desc("n"), F.length("gram"), "gram").limit(most).collect()}


ROW = "list string, kind int, id long, n long, word string"
#: A word in an index list; one that asks for words of its length; one that asks for words a letter shorter.
INDEXED, SAME, SHORTER = 0, 1, 2


def list_rows(words: DataFrame, known, rare: int) -> DataFrame:
    """Index and question rows of all words; a list is named by level, length, place and gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams(known.value)
        for batch in batches:
            for part in (batch.slice(a, 2000) for a in range(0, batch.num_rows, 2000)):
                out = []
                for i, n, w in zip(*(part.column(c).to_pylist() for c in ("id", "n", "word"))):
                    size = len(w)
                    cuts = {q: own.cut(w, q) for q in LEVELS if q == 2 or 2 * q <= size + 1}  # levels at which words of this length or one more ask
                    for q, grams in cuts.items():
                        out += [(f"{q}/{size}/{p}/{w[p:e]}", INDEXED, i, n, w) for p, e in grams]
                    q, asked = own.asks(w, rare, cuts)
                    for p, e in asked:
                        g = w[p:e]
                        out.append((f"{q}/{size}/{p}/{g}", SAME, i, n, w))
                        out.append((f"{q}/{size - 1}/{p}/{g}", SHORTER, i, n, w))
                        if p:
                            out.append((f"{q}/{size - 1}/{p - 1}/{g}", SHORTER, i, n, w))
                columns = zip(*out) if out else [()] * 5
                types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["list", "kind", "id", "n", "word"])

    return words.mapInArrow(run, ROW)


# Comparison

def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words one after the other, where each word begins and the last one ends)."""
    starts = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)])
    raw = "".join(words.to_pylist())
    try:
        return np.frombuffer(raw.encode("latin-1"), np.uint8), starts
    except UnicodeEncodeError:
        return np.frombuffer(raw.encode("utf-32-le"), np.uint32), starts


def one_replaced(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that differ in one letter."""
    n = b.shape[1]
    differ = np.zeros((len(a), len(b)), np.uint8 if n < 256 else np.uint32)
    for x, y in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):
        differ += x[:, None] != y
    return np.nonzero(differ == 1)


def one_deleted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs where the longer row of ``a`` becomes that of ``b`` by deleting one letter."""
    n = b.shape[1]
    longer, shorter = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    alike = np.zeros((len(a), len(b)), np.uint8 if n < 128 else np.uint32)
    for pairs in (zip(longer, shorter), zip(longer[:0:-1], shorter[::-1])):  # letters that agree from the front, then from the end
        so_far = np.ones(alike.shape, bool)
        for x, y in pairs:
            so_far &= x[:, None] == y
            alike += so_far
    return np.nonzero(alike >= n)


def compare_lists(rows: DataFrame) -> DataFrame:
    """(id, near_id, near_n, near_word) of all variants found in each list, both ways; rows come sorted by list and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # of a list that may go on
        for batch in batches:
            begin = int(starts_of(batch)[-1])
            if not begin and held and all(batch.column(c)[0] == held[0].column(c)[0] for c in ("list", "part")):
                held.append(batch)
                continue
            yield from found([*held, batch.slice(0, begin)])
            held = [batch.slice(begin)]
        yield from found(held)

    def starts_of(rows) -> np.ndarray:
        names, _ = coded(rows.column("list"))
        part = rows.column("part").to_numpy()
        return np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (part[1:] != part[:-1])]))

    def found(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(b.num_rows for b in held):
            return
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        begin = starts_of(rows)
        kinds, ids, ns = (rows.column(c).to_numpy() for c in ("kind", "id", "n"))
        words = rows.column("word")
        letters, at = letters_of(words)
        sizes = [np.add.reduceat(kinds == k, begin, dtype=np.int64) for k in (INDEXED, SAME, SHORTER)]
        ones, twos = [], []
        for g in np.flatnonzero((sizes[0] > 0) & (sizes[1] + sizes[2] > 0)).tolist():
            first = int(begin[g])
            last, size = first + int(sizes[0][g]), int(at[first + 1] - at[first])
            wide = max(1, min(last - first, BLOCK // size))
            tall = max(1, BLOCK // (size * wide))
            right = [(b, letters[at[b] : at[min(b + wide, last)]].reshape(-1, size)) for b in range(first, last, wide)]
            ask = last
            for kind, near in ((SAME, one_replaced), (SHORTER, one_deleted)):
                end = ask + int(sizes[kind][g])
                for a in range(ask, end, tall):
                    left = letters[at[a] : at[min(a + tall, end)]].reshape(-1, size + (near is one_deleted))
                    for b, indexed in right:
                        x, y = near(left, indexed)
                        if len(x):
                            ones.append(x + a)
                            twos.append(y + b)
                ask = end
        if not ones:
            return
        one, two = np.concatenate(ones), np.concatenate(twos)
        once = (kinds[one] == SHORTER) | (ids[one] < ids[two])
        one, two = one[once], two[once]
        of, near = np.concatenate([one, two]), np.concatenate([two, one])
        for a in range(0, len(of), 100_000):
            x, y = of[a : a + 100_000], near[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y]), pa.array(ns[y]), words.take(pa.array(y))], ["id", "near_id", "near_n", "near_word"])

    return rows.mapInArrow(run, "id long, near_id long, near_n long, near_word string")


# The operator

def near_words(words: DataFrame, list_goal: int = 300, most_grams: int = 100_000, list_rows_at_once: int = 4096) -> DataFrame:
    """(id, near_id, near_n, near_word): pairs of different words (id, n, word) with one replaced, inserted or deleted code point, both ways, each once.

    Words have at least five code points, ids and words are unique. Grams at more than ``list_goal`` places grow longer; the dictionary, broadcast,
    holds at most ``most_grams``. Lists longer than ``list_rows_at_once`` are dealt to several tasks, to each of which the words that ask go.
    """
    spark, parts = words.sparkSession, shuffle_partitions(words.sparkSession)
    grams = spark.sparkContext.broadcast(frequent_grams(words, list_goal, most_grams))
    rows = session.materialise(list_rows(words, grams, list_goal), "gram-lists")
    long_ones = rows.where(F.col("kind") == INDEXED).groupBy("list").count().where(F.col("count") > list_rows_at_once)
    long_ones = session.materialise(long_ones.select("list", F.ceil(F.col("count") / list_rows_at_once).cast("int").alias("parts")), "long-lists")  # of known size
    dealt = rows.join(long_ones, "list", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    to = F.when(F.col("kind") == INDEXED, F.array(F.pmod("id", "parts").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("part", F.explode(to)).drop("parts").repartition(parts, "list", "part").sortWithinPartitions("list", "part", "kind")
    return compare_lists(dealt).dropDuplicates(["id", "near_id"])


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last of word, form, the form's form and so on. Forms at least double in count, so few rounds do."""
    at = session.materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = session.materialise(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = further.drop("moved")
        if further.where("moved").isEmpty():
            return at


def group_variants(counts: DataFrame, least_n: int = 3, least_letters: int = 5, **limits) -> DataFrame:
    """One row per word of (word, n) with both at least the least: word, form, root, n, n_near, form_n.

    The form is the near word (one code point inserted, deleted or replaced) of largest n, of those the first in code-point order, if its n is at
    least twice the word's; else null, like form_n. The root is the last word that forms lead to, the word itself
    without one. Null words and counts and words under five code points are left out; repeated words are one with the sum of
    their counts. An empty table gives no rows; other columns are not read. ``limits`` go to ``near_words``.
    """
    known = counts.select("word", "n").where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    known = known.where((F.col("n") >= least_n) & (F.char_length("word") >= max(5, least_letters)))
    words = session.materialise(known.withColumn("id", F.monotonically_increasing_id()), "words")
    near = near_words(words, **limits).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word"))).alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    out = words.join(near, "id", "left").select(
        "word", F.when(enough, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")
    )
    out = session.materialise(out, "forms")
    return out.join(follow(out.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", misspell: int = 0, **limits) -> DataFrame:
    """``group_variants`` of the words of whole texts; see ``count_words`` for what a word is and for odd input."""
    return group_variants(count_words(docs, doc_id, text, misspell=misspell), **limits)
