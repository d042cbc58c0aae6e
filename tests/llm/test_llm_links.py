"""Spelling variants, the n-gram Jaccard join and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import check, connect
from conftest_llm import clashing, same, words

from tallywork.llm import jaccard, prefix_trie, spelling
from tallywork.llm.queries import CHECKS, QUERIES

# ---- spelling


def counted(rows):
    found = Counter()
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected_variants(rows):
    known = counted(rows)
    near = defaultdict(set)
    holes = defaultdict(set)  # only words that agree but for a hole can be one edit apart
    for w in known:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        if best is not None and known[best] >= 10 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), known[form[w]] if w in form else None) for w, n in known.items()}


@pytest.mark.parametrize("block", [4096, 7])
def test_variants_of_the_documents(docs, rows, block):
    found = spelling.variants(docs, block=block)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected_variants(rows), key=str)


def test_variants_edges(spark):
    stem, rare = "ordinarily", "ordinarilx"
    texts = [f"{stem} " * 300, f"{rare} {rare} " * 10, "ordinarilxz ordinarilxz", "xordinarily, XORDINARILY", "rdinarily-rdinarily", None, "", "short", "ÀÉÎõüçß×÷ ÀÉÎõüçß×÷ éÉÎõüçß×÷ éÉÎõüçß×÷"]
    texts += ["a" * 3000 + " " + "a" * 3000, "a" * 2999 + "b " + "a" * 2999 + "b", "abcdefg abcdefg abcdefgh abcdefgh bcdefgh bcdefgh"]
    data = [(i if i != 3 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = expected_variants(df.collect())
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of two forms
    assert set(map(tuple, spelling.variants(df, block=2).collect())) == want
    assert same(spelling.variants(clashing(df, "word", "form", "n", "root", "id")), spelling.variants(df))


def test_variants_random_alphabet(spark):
    dice = random.Random(5)
    texts = [" ".join("".join(dice.choice("ab") for _ in range(dice.randint(7, 9))) for _ in range(400)) for _ in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert set(map(tuple, spelling.variants(df, block=50).collect())) == expected_variants(df.collect())


def test_variants_odd_and_empty(odd, nothing):
    assert set(map(tuple, spelling.variants(odd).collect())) == expected_variants(odd.collect())
    assert spelling.variants(nothing).collect() == []


# ---- Jaccard join


def sets_of(rows):
    found = []
    for r in rows:
        w = words(r.text)
        k = min(5, len(w))
        found.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return found


def expected_join(rows):
    sets = sets_of(rows)
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    meet = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            meet[x].append(i)
    for i, j in {(i, j) for at in meet.values() for i in at for j in at if i < j}:
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            group[root(j)] = root(i)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)].append(r.doc_id)
    return sorted(((r.doc_id, len(sets[i]), r.doc_id if not sets[i] else min(least[root(i)], default=None)) for i, r in enumerate(rows)), key=str)


def joined(df, **how):
    found = jaccard.join_similar(df, **how)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, found.collect()), key=str)


def test_join_against_sql(spark, folder):
    assert check(QUERIES["op12_ngram_jaccard"], CHECKS["op12_ngram_jaccard"], spark, folder, connect(folder)) is None


def edited(dice, base, changes):
    text = list(base)
    for _ in range(changes):
        at = dice.randrange(len(text))
        text[at] = f"new{dice.randrange(10**6)}"
    return text


@pytest.mark.parametrize("how", [{}, {"block": 5, "dense": 3, "many": 4, "sample": 20, "frequent": 2}, {"dense": 1000, "many": 7}])
def test_join_of_near_copies(spark, how):
    """Groups of copies, some at the edge of 0.8, around a passage that most texts share."""
    dice = random.Random(11)
    passage = [f"common{i}" for i in range(40)]
    texts = []
    for group in range(6):
        base = [f"w{dice.randrange(5000)}" for _ in range(dice.choice([30, 60, 150]))] + passage
        texts += [edited(dice, base, dice.randint(0, 6)) for _ in range(12)]
    texts += [[f"only{i}x{j}" for j in range(12)] + passage for i in range(40)]
    texts += [passage, passage, passage[:-4], passage[:-1], ["one"], ["one"], ["one", "two"]]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    dice.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    want = expected_join(df.collect())
    assert len({x[2] for x in want}) < len(want) - 30
    assert joined(df, **how) == want


def test_join_at_the_threshold(spark):
    """9 of 11 and 8 of 10 shingles: 0.818 and exactly 0.8; 7 of 9: no link."""
    data = [(1, " ".join(f"a{i}" for i in range(14))), (2, " ".join([*(f"a{i}" for i in range(13)), "z"])), (3, " ".join(f"b{i}" for i in range(14))), (4, " ".join(f"b{i}" for i in range(12)))]
    data += [(5, " ".join(f"c{i}" for i in range(12))), (6, " ".join([*(f"c{i}" for i in range(11)), "q"]))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert joined(df) == expected_join(df.collect()) == [(1, 10, 1), (2, 10, 1), (3, 10, 3), (4, 8, 3), (5, 8, 5), (6, 8, 6)]


def test_join_odd_rows(odd, nothing):
    assert joined(odd) == expected_join(odd.collect())
    assert joined(nothing) == []
    assert same(jaccard.join_similar(clashing(odd, "row", "n", "columns", "component_id", "n_shingles")), jaccard.join_similar(odd))


def test_packed_columns_come_back():
    for n in (1, 2, 1000):
        columns = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n, dtype=np.uint64))
        assert (jaccard.unpacked(jaccard.packed(columns)) == columns).all()
    assert len(jaccard.unpacked(jaccard.packed(np.array([], np.uint64)))) == 0


# ---- prefix trie


def expected_nodes(rows):
    told = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            told[r.conv_id].append((r.turn is not None, r.turn or 0, code, (role, text)))
    lists = {c: [t[3] for t in sorted(x)] for c, x in told.items()}
    built = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = lists.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    found = []
    for node, convs in members.items():
        sub = [x for x in members if x[: len(node)] == node]
        childless = [x for x in sub if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in sub)]
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x)
        found.append((min(convs), len(node), parent, len(convs), sum(len(x) == len(node) + 1 for x in sub), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def nodes(df, **how):
    found = prefix_trie.prefix_nodes(df, **how)
    assert found.columns == prefix_trie.RESULT
    return sorted(map(tuple, found.collect()), key=str)


TALK = "conv_id long, turn long, role string, text string"


def test_trie_against_sql(spark, folder):
    assert check(QUERIES["op13_prefix_trie"], CHECKS["op13_prefix_trie"], spark, folder, connect(folder)) is None


@pytest.mark.parametrize("per_part", [50_000, 9, 2])
def test_trie_over_partitions(spark, per_part):
    """Few different turns, so that long prefixes run across many borders of partitions."""
    dice = random.Random(per_part)
    data = []
    for c in range(120):
        for t in range(dice.randint(0, 9)):
            data.append((c, t, dice.choice("ua"), dice.choice(["hi", "hi", "hi", "é", ""]) if t < 6 else "same end"))
    data += [(c, t, "u", "hi") for c in range(200, 230) for t in range(12)]
    df = spark.createDataFrame(data, TALK).repartition(5)
    assert nodes(df, per_part=per_part) == expected_nodes(df.collect())


def test_trie_odd_rows(spark):
    data = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, None, "a", "b"), (None, 1, "x", "y"), (0, 3, "user", "ü" * 70_000), (0, 3, "user", "w")]
    data += [(7, 1, "u", "t"), (-3, 1, "u", "t"), (-10, 1, "r", "s"), (11, 1, "1", "1a"), (11, 1, "11", "a")]
    df = spark.createDataFrame(data, TALK)
    assert nodes(df) == expected_nodes(df.collect())
    assert nodes(df.limit(0)) == []
    assert same(prefix_trie.prefix_nodes(clashing(df, "key", "seq", "part", "depth")), prefix_trie.prefix_nodes(df))


def test_trie_of_one_conversation_many_ids(spark):
    """Equal conversations: the ids are packed in blocks and hashed in their order."""
    df = spark.range(0, 1000, 1, 4).selectExpr("id * 5 as conv_id", "1L as turn", "'u' as role", "'t' as text")
    got = nodes(df)
    assert got == expected_nodes(df.collect())


def test_packs_of_one_sequence(spark, monkeypatch):
    from pyspark.sql import functions as F

    lines = spark.range(50).select("id", F.lit(b"0" * 16).alias("seq"), F.array(F.lit(3).cast("long")).alias("bytes")).coalesce(1)

    def few(batches):
        prefix_trie.PACK = 7
        yield from prefix_trie.packed(batches)

    got = lines.mapInArrow(few, "seq binary, bytes array<long>, first long, ids binary").collect()
    assert [r["first"] for r in got] == list(range(0, 50, 7))
    assert [x for r in got for x in np.frombuffer(r["ids"], "<i8")] == list(range(50))
