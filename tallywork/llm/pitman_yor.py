"""Scores of whole texts under a hierarchical Pitman-Yor language model.

Each token is drawn in the restaurant of its context, the whole word before it by its 64-bit hash;
a text starts after an end token. All context restaurants share one parent, the restaurant of
single words, whose base is uniform over the known words and one unknown word. Counts cover the
whole training corpus, and there are as many restaurants as it has different words.

Gibbs sweeps seat the customers of every restaurant anew, given what the last sweep left: the
tables of each context, and the parent's probability of each word. A score takes the average over
the sweeps of the predictive probability of each token.

How the work is spread. Tokens are counted where the texts are read, in chunks of documents, and
sent out by word as packed arrays. A bucket of words then has all counts and tables of its words,
so a sweep passes over the buckets. What each has counted in its contexts is dealt out by ranges of
the contexts' hashes, added up, and sent back to the buckets that have the context: a table of its
own, joined to the buckets in the next pass; the buckets are stored bucketed and don't move. Very
frequent words are split over buckets by context as well; their totals (there are at most
1 / HOT_SHARE) go to the driver. The scores of a chunk's documents are summed by bucket and sent
back to their chunk. Which words are split comes from a small sample and changes no draw: each
dish draws numbers that depend on its word, its context and the sweep.

What is approximate: within a sweep all dishes are seated against the totals of the last sweep, with
their own tables taken out, and not against each other's new ones, as one process would."""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import new_folder, released, small_batches, text_of, written
from tallywork.llm.labelled import fold

SWEEPS = 3
STRENGTH, PARENT_STRENGTH = 10.0, 10.0
CHUNK_TOKENS, CHUNK_DOCS = 1_500_000, 1 << 13
HOT_SHARE, HOT_DOCS = 0.0005, 500
#: Bytes of text for a bucket: some 1.5 million tokens.
BUCKET_BYTES = 10_000_000
#: Spark's own bound for the files of a bucketed table; a file may hold several buckets.
MOST_FILES = 100_000
#: Bytes of a bucket's counts, and of its entries, in one row: large rows cost the JVM many times their size.
PIECE = 200_000
END = b" "
HELD = np.uint16(1 << 15)
KINDS = "bucket long, chunk long, counts binary, entries binary"
#: Part scores are whole multiples of 1 / SCALE.
SCALE = float(1 << 30)
#: Numbers that are summed over all buckets besides those of split words.
SCALARS = 8


def squeezed(*arrays: np.ndarray) -> bytes:
    """The arrays compressed, first bytes of all numbers first: most high bytes are zero."""
    heads = np.array([len(a) for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(heads + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays))


def unsqueezed(raw: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    sizes, at, out = np.frombuffer(data, "<i8", len(kinds)), 8 * len(kinds), []
    for kind, n in zip(kinds, sizes.tolist()):
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T.copy().view(kind).reshape(n))
        at += n * width
    return out


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 17)


def halves(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^32 as low and high half, which compress apart."""
    return (numbers & 0xFFFF).astype("<u2"), (numbers >> 16).astype("<u2")


def whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint32) | high.astype(np.uint32) << np.uint32(16)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def runs(key: np.ndarray) -> np.ndarray:
    """Starts of the runs of a sorted array."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def counted(buckets: int, hot: frozenset[int]):
    """Chunks of documents as a row per bucket: word hashes, entries per word, context hashes;
    context, document (with the held-out bit) and count of each entry. A row of bucket -1 - chunk
    has the documents."""
    hot_words = np.array(sorted(hot), np.uint64)

    def chunk_rows(number: int, ids: list, held: list[bool], sizes: list[int], tokens: list[np.ndarray], vocabulary: dict, id_type) -> Iterator[dict]:
        words = list(vocabulary)
        hashes = np.array([hash_of(w) for w in words], np.uint64)
        vocabulary.clear()
        n_words = len(words)
        del words
        lengths = np.array(sizes)
        rank = np.empty(n_words, np.int32)
        by_hash = np.argsort(hashes)
        rank[by_hash] = np.arange(n_words)
        hashes = hashes[by_hash]
        w = rank[np.concatenate(tokens)]
        tokens.clear()
        del rank, by_hash
        doc = np.repeat(np.arange(len(ids), dtype=np.int16), lengths)
        u = np.empty(len(w), np.int32)
        u[1:] = w[:-1]  # at the start of a text: the end of another
        u[0] = w[-1]
        if n_words >> 25:  # one very long document: words take more bits
            order = np.lexsort((doc, u, w))
            w, u, doc = w[order], u[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(w) != 0) | (np.diff(u) != 0) | (np.diff(doc) != 0)]))
            count = np.diff(np.concatenate([first, [len(w)]])).astype("<u4")
            entry_word, entry_context, d = w[first], u[first], doc[first].astype("<u2")
            del w, u, doc
        else:
            key = w.astype(np.int64)
            for x, bits in ((u, 25), (doc, 13)):
                key <<= bits
                key |= x
            del w, u, doc, x
            key.sort()
            first = runs(key)
            count = np.diff(np.concatenate([first, [len(key)]])).astype("<u4")
            key = key[first]
            del first
            entry_word, entry_context, d = (key >> 38).astype(np.int32), (key >> 13 & (1 << 25) - 1).astype(np.int32), (key & (1 << 13) - 1).astype("<u2")
            del key
        own = (hashes >> np.uint64(8)) % np.uint64(buckets)
        entry_bucket = own[entry_word]
        spread = np.isin(hashes, hot_words)[entry_word]
        mixed = (hashes[entry_word[spread]] >> np.uint64(8)) + (hashes[entry_context[spread]] >> np.uint64(8)) * np.uint64(0x9E3779B97F4A7C15)
        entry_bucket[spread] = (mixed >> np.uint64(7)) % np.uint64(buckets)
        entry_bucket = entry_bucket.astype(np.int32)
        del spread, mixed
        order = np.argsort(entry_bucket, kind="stable").astype(np.int32)
        entry_bucket, entry_word, entry_context, d, count = (x[order] for x in (entry_bucket, entry_word, entry_context, d, count))
        del order
        held_bits = np.where(held, HELD, np.uint16(0)).astype("<u2")
        edges = np.concatenate([runs(entry_bucket), [len(entry_bucket)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            starts = runs(entry_word[a:b])
            per_word = np.diff(np.concatenate([starts, [b - a]])).astype("<u4")
            own_words = hashes[entry_word[a:b][starts]].astype("<u8")
            contexts, context = np.unique(entry_context[a:b], return_inverse=True)
            steps = np.diff(context, prepend=0).astype("<u4")
            yield {
                "bucket": int(entry_bucket[a]), "chunk": number, "counts": None,
                "entries": squeezed(np.diff(own_words, prepend=np.uint64(0)), per_word, np.diff(hashes[contexts], prepend=np.uint64(0)), *halves(steps), d[a:b] | held_bits[d[a:b]], count[a:b]),
            }
        table = pa.table({"doc_id": pa.array(ids, id_type), "held": pa.array(held, pa.bool_()), "n": pa.array(sizes, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        yield {"bucket": -1 - number, "chunk": number, "counts": None, "entries": sink.getvalue().to_pybytes()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("counts", pa.binary()), ("entries", pa.binary())])
        chunk = TaskContext.get().partitionId() << 32

        def fresh():
            vocabulary: dict = defaultdict()
            vocabulary.default_factory = vocabulary.__len__
            return [], [], [], [], vocabulary

        ids, held, sizes, tokens, vocabulary = fresh()
        size = 0
        for batch in batches:
            for doc_id, text, out in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                words.append(END)
                ids.append(doc_id)
                held.append(out)
                sizes.append(len(words))
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= CHUNK_TOKENS or len(ids) == CHUNK_DOCS:
                    for row in chunk_rows(chunk, ids, held, sizes, tokens, vocabulary, batch.column(0).type):
                        yield pa.RecordBatch.from_pylist([row], schema)
                    chunk, size = chunk + 1, 0
                    ids, held, sizes, tokens, vocabulary = fresh()
        if ids:
            for row in chunk_rows(chunk, ids, held, sizes, tokens, vocabulary, batch.column(0).type):
                yield pa.RecordBatch.from_pylist([row], schema)
        del ids, held, sizes, tokens, vocabulary
        released()

    return count


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each bucket, its counts and entries cut into pieces that ``chunk`` numbers. counts: word hashes, training tokens per word, context hashes; word, context
    and training count of each pair. entries: chunks, entries per pair; chunk, document and count of each entry.
    Rows of documents pass through. The rows come sorted by bucket and chunk."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("counts", pa.binary()), ("entries", pa.binary())])

    def merged(bucket: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        chunks = np.array([c for c, _ in held], "<i8")
        parts = [unsqueezed(raw, "<u8", "<u4", "<u8", "<u2", "<u2", "<u2", "<u4") for _, raw in held]
        held.clear()
        words, word = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        contexts, context = np.unique(np.concatenate([np.cumsum(p[2], dtype=np.uint64) for p in parts]), return_inverse=True)
        key = np.repeat(word << 32, np.concatenate([p[1] for p in parts]))
        shift = np.cumsum([0] + [len(p[2]) for p in parts]).tolist()
        key |= np.concatenate([context[i + np.cumsum(whole(p[3], p[4]), dtype=np.uint32).astype(np.int64)] for i, p in zip(shift, parts)])
        chunk = np.repeat(np.arange(len(parts), dtype="<u4"), [len(p[5]) for p in parts])
        doc, count = (np.concatenate([p[i] for p in parts]) for i in (5, 6))
        del parts, word, context
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = runs(key)
        doc, count, chunk = doc[order], count[order], chunk[order]
        del order
        pair_count = np.add.reduceat(np.where(doc & HELD, np.uint32(0), count), starts, dtype=np.int64)
        pair_word = (key[starts] >> 32).astype("<u4")
        per_word = np.bincount(pair_word, pair_count, len(words)).astype("<i8")
        gaps = [np.diff(x, prepend=np.uint64(0)) for x in (words, contexts)]
        counts = squeezed(gaps[0], per_word, gaps[1], pair_word, *halves(key[starts] & 0xFFFFFFFF), pair_count.astype("<i8"))
        per_pair = np.diff(np.concatenate([starts, [len(key)]])).astype("<u4")
        del key, starts, pair_word, pair_count, gaps
        entries = squeezed(chunks, per_pair, chunk, doc, count)
        for i in range(0, max(len(counts), len(entries)), PIECE):
            piece = {"bucket": bucket, "chunk": i // PIECE, "counts": counts[i : i + PIECE] or None, "entries": entries[i : i + PIECE] or None}
            yield pa.RecordBatch.from_pylist([piece], schema)

    now, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            bucket = batch.column(0)[i].as_py()
            if bucket < 0:
                yield batch.slice(i, 1)
                continue
            if bucket != now and held:
                yield from merged(now, held)
                released()
                held = []
            now = bucket
            held.append((batch.column(1)[i].as_py(), batch.column(3)[i].as_py()))
    if held:
        yield from merged(now, held)
    del held
    released()


def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, bytes, list[dict]]]:
    """Each bucket with its counts, entries and sums, put together from its pieces; rows come sorted
    by bucket and piece, and the first has the sums."""
    now, held = None, []

    def whole_bucket():
        counts, entries = (b"".join(r.get(name) or b"" for r in held) for name in ("counts", "entries"))
        sums = held[0].get("sums") or []
        held.clear()
        return now, counts, entries, sums

    for batch in batches:
        for row in batch.to_pylist():
            if held and row["bucket"] != now:
                yield whole_bucket()
            now = row["bucket"]
            held.append(row)
    if held:
        yield whole_bucket()


@dataclass
class Sweep:
    """What a sweep leaves for the next on the driver: tables of the contexts of each range, tables
    and parent's tables of the words that are split, and the sums over all words."""

    context_tables: np.ndarray
    hot_tables: np.ndarray
    hot_parents: np.ndarray
    tables: int = 0
    parents: int = 0


@dataclass
class Model:
    hot: np.ndarray  # hashes of the words that are split, sorted
    tokens: int = 0
    words: int = 0
    hot_counts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    discount: float = 0.5
    parent_discount: float = 0.5
    sweeps: list[Sweep] = field(default_factory=list)

    def parent(self, tables: np.ndarray, parents: np.ndarray, sweep: Sweep, without: np.ndarray | float = 0.0) -> np.ndarray:
        """The parent's probability of words with so many tables below and above, when ``without``
        of all tables are taken out."""
        base = (PARENT_STRENGTH + self.parent_discount * sweep.parents) / (self.words + 1)
        return (np.maximum(tables - self.parent_discount * parents, 0) + base) / (PARENT_STRENGTH + sweep.tables - without)

    def seated_above(self, below: np.ndarray, old: np.ndarray, sweep: Sweep, number: int, words: np.ndarray) -> np.ndarray:
        """The parent's tables of words with so many tables below; its base is uniform."""
        others = PARENT_STRENGTH + self.parent_discount * np.maximum(sweep.parents - old, 0)
        return seated(below, others, np.full(len(words), 1 / (self.words + 1)), self.parent_discount, keys_of(2 * number + 1, words))


def uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers between 0 and 1 that depend on key and step alone (splitmix64)."""
    x = keys + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def keys_of(sweep: int, words: np.ndarray, contexts: np.ndarray | None = None) -> np.ndarray:
    """What the draws of a dish depend on: the sweep, the word and its context, not the bucket."""
    keys = words * np.uint64(0xD6E8FEB86659FD93) + np.uint64(sweep)
    return keys if contexts is None else keys ^ ((contexts + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))


def seated(customers: np.ndarray, strength: np.ndarray, chance: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables that so many customers of one dish open, one after the other.

    With i seated at t tables, the next one opens a table with odds of
    (strength + discount * t) * chance to i - discount * t. Exact for any number of customers:
    while no table opens the probability only falls, so customers are passed over up to the next
    one who would open a table at today's probability, and who does with the share it has by then."""
    customers, tables = customers.astype(float), (customers > 0).astype(float)
    at = np.flatnonzero(customers > 1)
    i, t = np.ones(len(at)), np.ones(len(at))
    most, strength, chance, keys = customers[at], strength[at], chance[at], keys[at]
    step = 0
    while len(at):
        rate = (strength + discount * t) * chance
        now = np.minimum(rate / (rate + i - discount * t), 1 - 1e-16)
        arriving = i + np.floor(np.log(uniform(keys, step)) / np.log1p(-now))
        go = arriving < most
        if not go.all():
            tables[at[~go]] = t[~go]
            at, t, most, strength, chance, keys, rate, now, arriving = (x[go] for x in (at, t, most, strength, chance, keys, rate, now, arriving))
        then = rate / (rate + arriving - discount * t)
        t = t + (uniform(keys, step + 1) * now < then)
        i = arriving + 1
        step += 2
    return tables


def unpacked(counts: bytes) -> tuple[np.ndarray, ...]:
    """Word hashes, training tokens per word, context hashes; word, context, count of each pair."""
    words, per_word, contexts, word, low, high, count = unsqueezed(counts, "<u8", "<i8", "<u8", "<u4", "<u2", "<u2", "<i8")
    return np.cumsum(words, dtype=np.uint64), per_word, np.cumsum(contexts, dtype=np.uint64), word, whole(low, high), count


@dataclass
class Back:
    """What the ranges sent back for the bucket's contexts. Only contexts with a pair that some
    bucket has more than once can change their tables; the others are not sent again."""

    sums: list[dict]

    def __post_init__(self):
        self.first_tables, self.tokens, loose = self.of(0, 3)
        self.loose = loose > 0

    def of(self, number: int, arrays: int) -> list[np.ndarray]:
        own = sorted((r["part"], r["data"]) for r in self.sums if r["number"] == number)
        parts = [unsqueezed(data, *["<i8"] * arrays) for _, data in own]
        return [np.concatenate([p[i] for p in parts]).astype(float) if parts else np.zeros(0) for i in range(arrays)]

    def tables(self, number: int) -> np.ndarray:
        out = self.first_tables.copy()
        if number:
            out[self.loose] = self.of(number, 1)[0]
        return out


def replay(model: Model, bucket: int, counts: bytes, back: Back | None):
    """The bucket's state after each sweep known so far, and after one more: (tables of pairs,
    tables of words, parent's tables of words, sweep). A sweep depends on the one before and on
    its seed alone, so every pass and every retry finds the same."""
    words, per_word, contexts, word, context, count = unpacked(counts)
    split = np.isin(words, model.hot)
    place = np.searchsorted(model.hot, words[split])
    tables = (count > 0).astype(float)
    for n in range(len(model.sweeps) + 1):
        sweep = model.sweeps[n] if n < len(model.sweeps) else None
        if n:
            before, old, old_above = model.sweeps[n - 1], tables, above
            # The dish's own tables are taken out of the context and of the parent before it is seated anew.
            others = np.maximum(STRENGTH + model.discount * (back.tables(n - 1)[context] - old), STRENGTH)
            tables = seated(count, others, model.parent(below[word] - old, above[word], before, old), model.discount, keys_of(2 * n, words[word], contexts[context]))
        below = np.bincount(word, tables, len(words))
        if n:
            above = model.seated_above(np.where(split, 0, below), old_above, before, n, words)
        else:
            above = (below > 0).astype(float)
        own_below = below.copy()
        if sweep is not None:
            below[split], above[split] = sweep.hot_tables[place], sweep.hot_parents[place]
        yield n, tables, below, above, own_below, (words, per_word, contexts, word, context, count, split, place)


def totals(model: Model, number: int, parts: int):
    """What one sweep leaves in a bucket, as rows (part, bucket, data). Data are the tables of the
    contexts of one range, in the first pass also their hashes, training tokens and repeated pairs (later
    passes send the contexts that can change, whose places the range has kept); with bucket -1 keys and
    sums over the bucket's words: of split words their tables, in the first pass also training
    tokens; words and pairs that occur once and twice."""
    hot = len(model.hot)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, counts, _, found_sums in wholes(batches):
            back = Back(found_sums) if number else None
            for n, tables, below, above, own, (words, per_word, contexts, word, context, count, split, place) in replay(model, bucket, counts, back):
                if n == number:
                    break
            found = np.zeros(2 * hot + SCALARS, np.int64)
            np.add.at(found, hot + place, own[split].astype(np.int64))
            found[-1] = int(above[~split].sum())
            found[-8] = int(tables.sum())
            per_context = [np.bincount(context, tables, len(contexts)).astype("<i8")]
            if not number:
                per_context += [np.bincount(context, x, len(contexts)).astype("<i8") for x in (count, count > 1)]
                np.add.at(found, place, per_word[split])
                found[-2] = int(per_word.sum())
                found[-3] = int((per_word[~split] > 0).sum())
                found[-4], found[-5] = int((count == 1).sum()), int((count == 2).sum())
                found[-6], found[-7] = int((own[~split] == 1).sum()), int((own[~split] == 2).sum())
            else:
                contexts, per_context = contexts[back.loose], [per_context[0][back.loose]]
            part = ((contexts >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.int64)
            edges = np.concatenate([runs(part), [len(part)]])
            rows = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                hashes = [] if number else [np.diff(contexts[a:b], prepend=np.uint64(0))]
                rows.append((int(part[a]), bucket, squeezed(*hashes, *[x[a:b] for x in per_context])))
            key = np.flatnonzero(found)
            rows.append((bucket % parts, -1, squeezed(key.astype("<i8"), found[key])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                names=["part", "bucket", "data"],
            )
        released()

    return sums


def added(number: int, size: int):
    """The sums of each range of contexts, a row for each bucket with its contexts in their order,
    and with bucket -1 those over words and last the range's tables. The first pass adds a row of
    bucket -2 - part: where in the range's contexts that can change those of each bucket lie. Later
    passes get it back, and no hashes. Rows come sorted by part."""

    def summed_up(part: int, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        found = np.zeros(size + 2, np.int64)
        for _, data in (x for x in held if x[0] == -1):
            key, value = unsqueezed(data, "<i8", "<i8")
            found[key] += value
        rows, sent = [], {bucket: data for bucket, data in held if bucket >= 0}
        if sent and number:
            owners, sizes, gaps = unsqueezed(next(data for bucket, data in held if bucket < -1), "<i8", "<i8", "<u4")
            edges = np.cumsum(np.append(0, sizes)).tolist()
            places = [np.cumsum(gaps[a:b], dtype=np.int64) for a, b in zip(edges[:-1], edges[1:])]
            total = np.zeros(1 + max(int(at[-1]) for at in places), np.int64)
            for bucket, at in zip(owners.tolist(), places):  # a bucket has a context once
                total[at] += unsqueezed(sent[bucket], "<i8")[0]
            rows = [(bucket, squeezed(total[at])) for bucket, at in zip(owners.tolist(), places)]
            found[-1] = int(total.sum())
        elif sent:
            own = [unsqueezed(data, "<u8", "<i8", "<i8", "<i8") for data in sent.values()]
            contexts, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in own]), return_inverse=True)
            total = [np.bincount(at, np.concatenate([x[i] for x in own]), len(contexts)).astype("<i8") for i in (1, 2, 3)]
            edges = np.cumsum([0] + [len(x[0]) for x in own]).tolist()
            rows = [(bucket, squeezed(*[t[at[a:b]] for t in total])) for bucket, a, b in zip(sent, edges[:-1], edges[1:])]
            found[-1] = int(total[0].sum())
            found[-2] = int(total[0][total[2] == 0].sum())  # tables that stay
            loose = total[2] > 0
            place = np.cumsum(loose) - 1
            places = {bucket: place[x[loose[x]]] for bucket, a, b in zip(sent, edges[:-1], edges[1:]) for x in [at[a:b]]}
            places = {bucket: x for bucket, x in places.items() if len(x)}
            if places:
                gaps = np.concatenate([np.diff(x, prepend=0) for x in places.values()]).astype("<u4")
                rows.append((-2 - part, squeezed(np.array(list(places), "<i8"), np.array([len(x) for x in places.values()], "<i8"), gaps)))
        key = np.flatnonzero(found)
        rows.append((-1, squeezed(key.astype("<i8"), found[key])))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([number] * len(rows), pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
            names=["bucket", "number", "part", "data"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, bucket, data in zip(*[c.to_pylist() for c in batch.columns]):
                if part != now and held:
                    yield summed_up(now, held)
                    held = []
                now = part
                held.append((bucket, data))
        if held:
            yield summed_up(now, held)
        del held
        released()

    return add


def bucketed(rows: DataFrame, buckets: int, name: str) -> DataFrame:
    """``rows`` as a stored table in which a bucket has its place: it joins with others of the kind
    without a shuffle. The files lie in the shared folder; the catalogue's name is not kept."""
    spark = rows.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    rows.write.bucketBy(min(buckets, MOST_FILES), "bucket").option("path", new_folder(spark, name)).format("parquet").saveAsTable(table)
    found = spark.table(table)
    found.schema  # resolved: the files are read from here on
    spark.sql(f"drop table {table}")
    return found


def joined(buckets: DataFrame, sums: list[DataFrame], *columns: str) -> DataFrame:
    """The pieces of the buckets in order, the first with all that came back for the bucket's
    contexts; neither side is moved."""
    own = buckets.filter(F.coalesce(*columns).isNotNull()).select("bucket", "chunk", *columns)
    names = []
    for i, some in enumerate(sums):
        back = some.filter("bucket >= 0").groupBy(F.col("bucket").alias(f"bucket{i}")).agg(F.collect_list(F.struct("number", "part", "data")).alias(f"sums{i}"))
        own = own.join(back.hint("shuffle_hash"), (F.col("bucket") == F.col(f"bucket{i}")) & (F.col("chunk") == 0), "left")
        names.append(F.coalesce(f"sums{i}", F.array().cast(back.schema[f"sums{i}"].dataType)))
    return own.select("bucket", "chunk", *columns, *([F.concat(*names).alias("sums")] if names else [])).sortWithinPartitions("bucket", "chunk")


def stats_of(buckets: DataFrame, parts: int, model: Model, number: int, sums: list[DataFrame]) -> tuple[dict[int, int], np.ndarray]:
    """One more pass. Its sums by context are put to ``sums``; those of split words and over all
    words are returned (the latter from -1 downwards), and of each range of contexts the tables that stay and those sent."""
    size = 2 * len(model.hot) + SCALARS
    rows = joined(buckets, sums, "counts").mapInArrow(totals(model, number, parts), "part long, bucket long, data binary")
    if number:
        rows = rows.union(sums[0].filter("bucket < -1").select("part", "bucket", "data"))
    rows = rows.repartition(parts, "part").sortWithinPartitions("part")
    found = rows.mapInArrow(added(number, size), "bucket long, number int, part long, data binary")
    sums.append(bucketed(found.repartition(parts, "bucket"), parts, f"context-sums-{number}"))
    found, tables = np.zeros(size, np.int64), []
    for row in sums[-1].filter("bucket = -1").select("data").toLocalIterator():
        key, value = unsqueezed(row["data"], "<i8", "<i8")
        found[key[key < size]] += value[key < size]
        tables.append([int(value[key == size + i].sum()) for i in (0, 1)])
    return {(k if k < size - SCALARS else k - size): int(v) for k, v in enumerate(found)}, np.array(tables, float).reshape(-1, 2)


def trained(buckets: DataFrame, parts: int, hot: frozenset[int], sweeps: int, sums: list[DataFrame]) -> Model:
    model = Model(np.array(sorted(hot), np.uint64))
    n = len(model.hot)
    stats, tables = stats_of(buckets, parts, model, 0, sums)
    model.hot_counts = np.array([stats[j] for j in range(n)], float)
    model.tokens = stats[-2]
    model.words = stats[-3] + int((model.hot_counts > 0).sum())
    share = lambda once, twice: min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    below = np.array([stats[n + j] for j in range(n)], float)
    model.discount = share(stats[-4], stats[-5])
    model.parent_discount = share(stats[-6] + int((below == 1).sum()), stats[-7] + int((below == 2).sum()))
    model.sweeps = [Sweep(tables[:, 1], below, (below > 0).astype(float), stats[-8], model.words)]  # every pair, and every word, with one table
    staying = tables[:, 0].sum()
    for number in range(1, sweeps + 1):
        stats, tables = stats_of(buckets, parts, model, number, sums)
        below = np.array([stats[n + j] for j in range(n)], float)
        last = model.sweeps[-1]
        above = model.seated_above(below, last.hot_parents, last, number, model.hot)
        model.sweeps.append(Sweep(np.append(tables[:, 1], staying), below, above, stats[-8], stats[-1] + int(above.sum())))
    return model


def evaluated(model: Model):
    """Sums for a bucket's part of each chunk: document, unknown tokens, base and model log10."""

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, counts, entries, found_sums in wholes(batches):
            average = np.float64(0.0)
            back = Back(found_sums)
            context_tokens = back.tokens
            for n, tables, below, above, _, (words, per_word, _, word, context, count, split, place) in replay(model, bucket, counts, back):
                if not n:
                    continue
                sweep = model.sweeps[n]
                parent = model.parent(below, above, sweep)[word]
                strength = STRENGTH + model.discount * back.tables(n)[context]
                average = average + (count - model.discount * tables + strength * parent) / (STRENGTH + context_tokens[context])
                if n == len(model.sweeps) - 1:
                    break
            log_p = np.log10(average / (len(model.sweeps) - 1))
            seen = per_word.astype(float)
            seen[split] = model.hot_counts[place]
            log_base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (model.words + 1)))[word]
            unknown = (seen == 0)[word]
            del back, found_sums, context_tokens, tables, below, above, words, per_word, word, context, count, split, place, parent, strength, average, seen, counts
            chunks, per_pair, chunk, doc, times = unsqueezed(entries, "<i8", "<u4", "<u4", "<u2", "<u4")
            pair = np.repeat(np.arange(len(per_pair), dtype=np.int32), per_pair)
            places = chunk.astype(np.uint64 if len(chunks) >> 17 else np.uint32)
            places <<= 15
            places |= doc & ~HELD
            places, at = np.unique(places, return_inverse=True)
            places = places.astype(np.int64)
            sums = [np.bincount(at, unknown[pair] * times, len(places)).astype("<u4")]
            for x in (log_base, log_p):  # whole numbers add up alike in any order
                sums.append(np.rint(-np.bincount(at, x[pair] * times, len(places)) * SCALE).astype(np.int64))
            edges = np.concatenate([runs(places >> 15), [len(places)]])
            rows = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                planes = [x for some in sums[1:] for x in ((some[a:b] & 0xFFFFFFFF).astype("<u4"), (some[a:b] >> 32).astype("<i4"))]
                part = squeezed((places[a:b] & (HELD - 1)).astype("<u2"), sums[0][a:b], *planes)
                rows.append((bucket, int(chunks[places[a] >> 15]), part))
            del chunk, doc, times, pair, at, places, sums, log_base, log_p, unknown
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                names=["bucket", "chunk", "entries"],
            )
            released()

    return evaluate


def summed(model: Model, schema: T.StructType):
    """The documents of a chunk with their sums; rows come sorted by chunk and bucket, documents first."""
    tokens = model.tokens

    def out(table: pa.Table, sums: np.ndarray) -> pa.RecordBatch:
        n = len(table)
        known = pa.array(table["n"].to_numpy() - sums[0])
        columns = [table["doc_id"], table["held"], table["n"], known, pa.array(np.full(n, tokens)), pa.array(-sums[1] / SCALE), pa.array(-sums[2] / SCALE)]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = None, np.zeros((3, 0), np.int64)
        for batch in batches:
            for bucket, entries in zip(batch.column(0).to_pylist(), batch.column(2)):
                if bucket < 0:
                    if table is not None:
                        yield out(table, sums)
                    table = pa.ipc.open_stream(entries.as_py()).read_all()
                    sums = np.zeros((3, len(table)), np.int64)
                else:
                    doc, unknown, *planes = unsqueezed(entries.as_py(), "<u2", "<u4", "<u4", "<i4", "<u4", "<i4")
                    sums[0, doc] += unknown
                    for i in (0, 1):
                        sums[i + 1, doc] += planes[2 * i].astype(np.int64) + (planes[2 * i + 1].astype(np.int64) << 32)
        if table is not None:
            yield out(table, sums)

    return add


def frequent(docs: DataFrame) -> frozenset[int]:
    """Hashes of the words with at least HOT_SHARE of the tokens of HOT_DOCS documents."""
    counts: Counter = Counter()
    for row in docs.select("text").orderBy(F.xxhash64("doc_id"), "text").limit(HOT_DOCS).toLocalIterator():
        words = words_of(row["text"])
        counts.update(words[:: 1 + len(words) // 20_000])
        counts[END] += 1
    least = HOT_SHARE * sum(counts.values())
    return frozenset(hash_of(word) for word, n in counts.items() if n >= least)


def scored(docs: DataFrame, sweeps: int = SWEEPS, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and
    the text's perplexity.

    The model learns from documents whose crc32 of the id modulo 5 is not 1. Null texts are empty:
    one end token. Rows that repeat come back as often, and count as often in training; ids may be
    null (they train). Without training documents every token is unknown. Other columns are not
    read; an empty table gives no rows. The buckets' counts are written to the shared folder; there
    is one for each ``bucket_bytes`` of text, whatever the session's settings. The draws depend on
    word, context and sweep, so neither the number of buckets nor which words are split changes a
    score (beyond the rounding of sums)."""
    with small_batches(docs.sparkSession):
        found = _scored(docs, sweeps, doc_id, text, bucket_bytes)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def _scored(docs: DataFrame, sweeps: int, doc_id: str, text: str, bucket_bytes: int) -> DataFrame:
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    source = source.withColumn("held_out", fold("doc_id", 5) == 1)
    hot = frequent(source)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(size // bucket_bytes)
    rows = source.mapInArrow(counted(buckets, hot), KINDS)
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(gathered, KINDS)
    table = bucketed(rows, buckets, "word-counts")
    own, sums = table.filter("bucket >= 0"), []
    model = trained(own, buckets, hot, sweeps, sums)
    schema = T.StructType([source.schema["doc_id"]] + [T.StructField(n, k) for n, k in (
        ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()),
        ("base_score", T.DoubleType()), ("score", T.DoubleType()),
    )])
    parts = joined(own, sums, "counts", "entries").mapInArrow(evaluated(model), "bucket long, chunk long, entries binary")
    parts = parts.union(table.filter("bucket < 0").select("bucket", "chunk", "entries"))
    found = parts.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(summed(model, schema), schema)
    return written(found, "scores")
