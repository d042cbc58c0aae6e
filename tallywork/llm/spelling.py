"""Spelling variants: words one edit apart, found by an asymmetric join of chunks and grams.

Of two words the shorter one (or either, if they are as long) contributes two disjoint chunks, its
first and its last half; the other contributes its positional grams of that size, as many as a
chunk can meet within a shift of one place. One inserted, deleted or replaced letter leaves one of
the two chunks whole, at its place or the next. So the join on chunk and gram, of words as long or
one longer, loses no pair; what it finds is verified letter by letter.

Words go to the join by the hash of chunk or gram and length. A group is compared in place and only
its verified pairs leave it; a chunk that more than BLOCK words have is dealt out in blocks of
words, and its grams copied to each block."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import released, text_of, written

#: Letters of a word, all in Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
OFTEN = 2
#: A form is at least this many times as frequent as the word.
RATIO = 10
#: One in so many runs, by its hash, loses a letter.
DELETED = 31
#: Different words that a task counts before it passes them on.
KEPT = 150_000
#: Words of one chunk in one block.
BLOCK = 4096
#: Comparisons made at a time, and rows held until whole groups of them are compared.
STEP = 400_000
HELD = 80_000


def run_counts(docs: DataFrame, doc_id: str, text: str, shortest: int) -> DataFrame:
    """(word, n): words of ``shortest`` letters or more, as often as they occur."""
    source = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), text_of(text).alias("text"))
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                start = zlib.crc32(f"{key.as_py()}:".encode())
                low = value.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for run, n in Counter(runs.findall(low)).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % DELETED == 0:
                        place = h % len(run)
                        run = run[:place] + run[place + 1 :]
                        if len(run) < shortest:
                            continue
                    total[run] += n
                if len(total) > KEPT:
                    yield passed()
        yield passed()

    return source.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def key_of(part: Column, length: Column) -> Column:
    return F.xxhash64(length, part)


def chunk_rows(words: DataFrame) -> DataFrame:
    """Two rows a word: length, key, the chunk's number and place."""
    length, q = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    parts = F.array(
        F.struct(key_of(F.substring("word", F.lit(1), q), length).alias("key"), F.lit(0).alias("which"), F.lit(0).alias("place")),
        F.struct(key_of(F.substring("word", length - q + 1, q), length).alias("key"), F.lit(1).alias("which"), (length - q).alias("place")),
    )
    rows = words.select("word", "n", length.alias("length"), F.explode(parts).alias("p"))
    return rows.select("length", "p.key", F.lit(0).alias("kind"), "p.which", "p.place", "word", "n")


def gram_rows(words: DataFrame) -> DataFrame:
    """The positional grams of a word for chunks of words as long, and of words one letter shorter,
    at the places that such a chunk can take within a shift of one."""
    size = F.length("word")
    found = []
    for less in (0, 1):
        length = size - less
        q = F.floor(length / 2).cast("int")
        for which, first in ((0, F.lit(0)), (1, length - q)):
            for shift in range(less + 1):
                place = first + shift
                key = key_of(F.substring("word", place + 1, q), length)
                found.append(F.struct(length.alias("length"), key.alias("key"), F.lit(which).alias("which"), place.alias("place")))
    rows = words.select("word", "n", F.explode(F.array(*found)).alias("p"))
    return rows.select("p.length", "p.key", F.lit(1).alias("kind"), "p.which", "p.place", "word", "n")


def dealt(words: DataFrame, block: int) -> DataFrame:
    """Chunks and grams with the block of words they belong to."""
    chunks, grams = chunk_rows(words), gram_rows(words)
    counts = chunks.groupBy("length", "key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > block)
    large = written(counts.select("length", "key", F.ceil(F.col("rows") / block).cast("long").alias("blocks")), "large-chunks")
    one = F.coalesce(F.col("blocks"), F.lit(1).cast("long"))
    left = chunks.join(large, ["length", "key"], "left").withColumn("block", F.pmod(F.xxhash64("word"), one))
    right = grams.join(large, ["length", "key"], "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), one - 1)))
    return left.drop("blocks").unionByName(right.drop("blocks"))


def letters(words: list[bytes], width: int, back: bool) -> np.ndarray:
    """Words (or the words read backwards) as rows of ``width`` 64-bit numbers, first letter lowest."""
    shown = [w[::-1] for w in words] if back else words
    return np.array(shown, f"S{8 * width}").view("<u8").reshape(len(words), width)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many letters two words share from the first on."""
    total, alive = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for i in range(a.shape[1]):
        x = a[:, i] ^ b[:, i]
        total += np.where(alive, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3, 0)
        alive &= x == 0
    return total


def joined(length: int, key, block, kind, which, place, words: list[bytes], n) -> Iterator[pa.RecordBatch]:
    """Verified pairs of one length of chunk words; rows are sorted by key, block and kind."""
    q, width = length // 2, length // 8 + 1
    ahead, back = letters(words, width, False), letters(words, width, True)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    chunks = np.bincount(group, kind == 0, len(starts)).astype(np.int64)
    grams = np.flatnonzero(kind == 1)
    grams = grams[chunks[group[grams]] > 0]
    many = chunks[group[grams]]
    low = 0
    while low < len(grams):
        upto = np.cumsum(many[low : low + STEP])
        high = low + max(1, int(np.searchsorted(upto, STEP, side="right")))
        own = many[low:high]
        v = np.repeat(grams[low:high], own)
        u = np.arange(len(v)) - np.repeat(upto[: high - low] - own, own) + starts[group[v]]
        low = high
        # A shift is that of the longer word's extra letter, so none if both are as long.
        shift, extra = place[v] - place[u], sizes[v] - length
        keep = (which[u] == which[v]) & (shift >= 0) & (shift <= extra)
        u, v = u[keep], v[keep]
        first = agreeing(ahead[u], ahead[v])
        keep = first + agreeing(back[u], back[v]) >= sizes[v] - 1
        u, v, first = u[keep], v[keep], first[keep]
        # Of the matches of a pair the one: its first chunk unmoved, or else its last chunk.
        shift, extra = place[v] - place[u], sizes[v] - length
        keep = np.where(which[u] == 0, shift == 0, (first < q) & (shift == extra))
        pairs = [(words[i], words[j], n[i], n[j]) for i, j in zip(u[keep].tolist(), v[keep].tolist()) if len(words[i]) < len(words[j]) or words[i] < words[j]]
        if pairs:
            made = [pa.array([p[i].decode("latin-1") for p in pairs], pa.string()) for i in (0, 1)] + [pa.array([p[i] for p in pairs], pa.int64()) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(made, names=["u", "v", "nu", "nv"])


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v, nu, nv): each two words one edit apart, once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = {c: table.column(c).to_numpy() for c in ("length", "key", "block", "kind", "which", "place", "n")}
            words = [w.decode("utf-8").encode("latin-1") for w in table.column("word").cast(pa.binary()).to_pylist()]
            cuts = [0, *(np.flatnonzero(np.diff(columns["length"])) + 1).tolist(), len(words)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    c = {k: x[a:b] for k, x in columns.items()}
                    yield from joined(int(c["length"][0]), c["key"], c["block"], c["kind"], c["which"], c["place"], words[a:b], c["n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= HELD or sum(x.nbytes for x in held) >= 1 << 24:
                table = pa.Table.from_batches(held)
                ends = [table.column(c)[size - 1].as_py() for c in ("length", "key", "block")]
                same = np.ones(size, bool)
                for c, end in zip(("length", "key", "block"), ends):
                    same &= table.column(c).to_numpy() == end
                edge = int(np.argmax(same))
                if edge:
                    yield from flush(table.slice(0, edge))
                    held = table.slice(edge).to_batches()
                    size -= edge
        if held:
            yield from flush(pa.Table.from_batches(held))
        del held
        released()

    rows = dealt(words, block).repartition("length", "key", "block").sortWithinPartitions("length", "key", "block", "kind")
    return rows.mapInArrow(found, "u string, v string, nu long, nv long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead from each word that has one. A form is RATIO times as
    frequent as its word, so chains are short; their length is halved in each round."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = written(now, "roots")
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, often: int = OFTEN, ratio: int = RATIO, block: int = BLOCK
) -> DataFrame:
    """A row per word: word, form, root (strings); n, n_near, form_n (longs).

    Words are runs of letters (A-Z in lower case) of ``shortest`` letters or more that occur
    ``often`` times or more in all texts; one in DELETED runs, by the checksum of the document's
    id and the run, first loses a letter. Two words are near if one edit apart. A word's form is
    its most frequent near word (of equal ones the first in code-point order), if that is ``ratio``
    times as frequent, else null; the root is where forms lead, the word itself if it has none.
    ``shortest`` has to be 2 or more.

    A null text has no words; a null id counts as the empty text in the checksum. Rows that repeat
    count as often as they come. Other columns of ``docs`` are not read; an empty table gives no
    rows."""
    counts = run_counts(docs, doc_id, text, shortest)
    words = written(counts.filter(F.col("n") >= often), "words")
    pairs = written(near_pairs(words, block), "near-words")
    ends = F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("nv").alias("m")), F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("nu").alias("m")))
    sides = pairs.select(F.explode(ends).alias("e")).select("e.*")
    best = F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best")
    around = words.join(sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "word", "left")
    large = -F.col("best.m") >= ratio * F.col("n")
    found = written(
        around.select(
            "word", F.when(large, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(large, -F.col("best.m")).alias("form_n")
        ),
        "forms",
    )
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
