from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import clashing, words

from tallywork.llm import pitman_yor, quality, toxicity
from tallywork.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n if doc_id is not None else 0


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


# --- language model


def corpus_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        if remainder(doc_id, 5) != 1:
            counts.update([*words(text), " "])
    return counts, sum(counts.values()), len(counts)


def test_scores_of_a_whole_table(spark, folder, rows):
    got = {r.doc_id: r for r in QUERIES["op2_pitman_yor"](spark, folder).collect()}
    counts, n, v = corpus_counts([(r.doc_id, r.text) for r in rows])
    base = model = 0.0
    for r in rows:
        own, g = [*words(r.text), " "], got[r.doc_id]
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (remainder(r.doc_id, 5) == 1, len(own), sum(w in counts for w in own), n)
        assert math.isclose(g.base_score, want, rel_tol=1e-9)
        if g.held_out:
            base, model = base + g.base_score, model + g.score
    assert model > 0.95 * base  # held-out texts are likelier than under single words


def test_probabilities_of_a_context_sum_to_one(spark):
    """Every known word and the unknown one after a given word."""
    train = [(i, t) for i, t in enumerate(["a b a c", "b a b", "c c a b a", "a", "d a b"] * 3, 100) if remainder(i, 5) != 1]
    vocabulary = ["a", "b", "c", "d", "unheard"]
    tests = [i for i in range(2000, 4000) if remainder(i, 5) == 1][: 2 * len(vocabulary)]
    asked = [(tests[k], f"a {w}") for k, w in enumerate(vocabulary)] + [(tests[-1], "a")]
    docs = spark.createDataFrame(train + asked, "doc_id long, text string")
    score = {r.doc_id: r.score for r in pitman_yor.scored(docs).collect()}
    # "a w END" has the factors (a | start), (w | a), (END | w); take the last two apart by (END | a)
    singles = {w: score[tests[k]] for k, w in enumerate(vocabulary)}
    assert all(s < 0 for s in singles.values())
    model = None
    original = pitman_yor.trained

    def keep(*args):
        nonlocal model
        model = original(*args)
        return model

    pitman_yor.trained = keep
    try:
        pitman_yor.scored(docs).count()
    finally:
        pitman_yor.trained = original
    assert model.words == 5  # a, b, c, d and the end
    for sweep in model.sweeps:
        total = pitman_yor.PARENT_STRENGTH + sweep.tables
        rest = (pitman_yor.PARENT_STRENGTH + model.parent_discount * sweep.parents) + sweep.tables - model.parent_discount * sweep.parents
        assert math.isclose(rest, total) and math.isclose(sweep.context_tables.sum(), sweep.tables)


def test_every_previous_word_is_a_context_of_its_own(spark):
    """Long words with one ending, and more words than a fixed number of classes would hold."""
    ids = [i for i in range(2000) if remainder(i, 5) != 1]
    train = [(i, "national park") for i in ids[:40]] + [(i, "regional train") for i in ids[40:80]]
    pairs = [f"k{i:05d} v{i % 5}" for i in range(20_000)]
    train += [(i, " ".join(pairs * 2)) for i in ids[80:81]]
    held = [i for i in range(2000, 4000) if remainder(i, 5) == 1]
    asked = ["national park", "regional park", "regional train", "national train", " ".join(pairs), " ".join(f"k{i:05d} v{(i + 1) % 5}" for i in range(20_000))]
    docs = spark.createDataFrame(train + list(zip(held, asked)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in pitman_yor.scored(docs).collect()}
    own = [got[i] for i in held[: len(asked)]]
    assert own[0] > own[1] + 0.5 and own[2] > own[3] + 0.5
    assert own[4] > own[5] + 0.1 * 20_000


@pytest.mark.parametrize("rate", [0.5, 20.0])
def test_seating_follows_the_restaurant(rate):
    """Mean number of tables against seating one customer at a time."""
    rng = random.Random(1)
    customers = np.array([0, 1, 2, 5, 40, 300])
    strength, chance = np.full(6, 4 * rate), np.full(6, 0.25)
    dishes = np.arange(6, dtype=np.uint64)
    means = np.mean([pitman_yor.seated(customers, strength, chance, 0.6, pitman_yor.keys_of(i, dishes)) for i in range(300)], axis=0)
    plain = []
    for n in customers.tolist():
        runs = []
        for _ in range(300):
            tables = min(n, 1)
            for i in range(1, n):
                open_ = (4 * rate + 0.6 * tables) * 0.25
                tables += rng.random() < open_ / (open_ + i - 0.6 * tables)
            runs.append(tables)
        plain.append(np.mean(runs))
    assert np.allclose(means, plain, rtol=0.12, atol=0.1)


def test_seating_of_very_many_customers():
    """A million customers take a step per table or so, not one each; the mean grows like n ** discount."""
    customers = np.full(200, 1_000_000)
    tables = pitman_yor.seated(customers, np.full(200, 1.0), np.ones(200), 0.3, pitman_yor.keys_of(1, np.arange(200, dtype=np.uint64)))
    # E[tables] + strength / discount = (strength / discount) * (strength + discount)_n / (strength)_n
    want = (1 / 0.3) * (math.exp(math.lgamma(1_000_001.3) - math.lgamma(1.3) - math.lgamma(1_000_001) + math.lgamma(1.0)) - 1)
    assert math.isclose(tables.mean(), want, rel_tol=0.05)


def plain_scores(rows, sweeps, rng):
    """The same model with one restaurant after the other and one customer after the other."""
    pairs, tokens = Counter(), Counter()
    for doc_id, text in rows:
        if remainder(doc_id, 5) != 1:
            own = [" ", *words(text), " "]
            pairs.update(zip(own, own[1:]))
            tokens.update(own[:-1])
    known = {w for _, w in pairs}
    share = lambda counts: min(0.95, max(0.05, sum(c == 1 for c in counts) / max(1, sum(c == 1 for c in counts) + 2 * sum(c == 2 for c in counts))))
    tables = {p: 1 for p in pairs}
    below = Counter(w for _, w in pairs)
    discount, upper = share(list(pairs.values())), share(list(below.values()))
    above = {w: 1 for w in known}
    strength = pitman_yor.STRENGTH

    def seat(n, odds, chance, d):
        t = min(n, 1)
        for i in range(1, n):
            rate = (odds + d * t) * chance
            t += rng.random() < rate / (rate + i - d * t)
        return t

    def parent(w, below, above, out=0):
        base = (strength + upper * sum(above.values())) / (len(known) + 1)
        return (max(below[w] - out - upper * above.get(w, 0), 0) + base) / (strength + sum(below.values()) - out)

    found = []
    for _ in range(sweeps):
        per_context = Counter()
        for (u, _), t in tables.items():
            per_context[u] += t
        new = {(u, w): seat(c, strength + discount * (per_context[u] - tables[u, w]), parent(w, below, above, tables[u, w]), discount) for (u, w), c in pairs.items()}
        total = sum(above.values())
        tables, below = new, Counter()
        for (_, w), t in new.items():
            below[w] += t
        above = {w: seat(below[w], strength + upper * (total - above[w]), 1 / (len(known) + 1), upper) for w in known}
        per_context = Counter()
        for (u, _), t in tables.items():
            per_context[u] += t
        found.append((dict(tables), per_context, dict(above), Counter(below)))
    out = {}
    for doc_id, text in rows:
        own = [" ", *words(text), " "]
        score = 0.0
        for u, w in zip(own, own[1:]):
            p = [
                (pairs[u, w] - discount * t.get((u, w), 0) + (strength + discount * per[u]) * parent(w, b, a)) / (strength + tokens[u])
                for t, per, a, b in found
            ]
            score += math.log10(sum(p) / len(p))
        out[doc_id] = score
    return out


def test_scores_against_one_customer_at_a_time(spark):
    """The mean of plain runs, for a corpus of skewed words; and the same scores in any number of
    buckets."""
    dice = random.Random(4)
    rows = [(i, " ".join(f"w{min(int(dice.expovariate(0.25)), 60)}" for _ in range(dice.randint(0, 40)))) for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pitman_yor.scored(docs).collect()}
    runs = [plain_scores(rows, pitman_yor.SWEEPS, random.Random(i)) for i in range(4)]
    for doc_id, _ in rows:
        want = np.mean([run[doc_id] for run in runs])
        assert math.isclose(got[doc_id].score, want, rel_tol=0.02, abs_tol=0.2)
        assert math.isclose(got[doc_id].perplexity, 10 ** (-got[doc_id].score / got[doc_id].n_tokens))
    many = {r.doc_id: r.score for r in pitman_yor.scored(docs, bucket_bytes=2_000).collect()}
    assert all(math.isclose(many[i], got[i].score, rel_tol=1e-9) for i, _ in rows)


def test_rows_reach_python_in_small_batches(spark, monkeypatch):
    """Long texts and packed counts of one partition don't meet in one batch, and the session keeps
    its setting."""
    most, key = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

    def watched(make):
        def made(*args):
            inner = make(*args)

            def run(batches):
                def small():
                    for batch in batches:
                        if batch.num_rows > 1 and batch.nbytes > 2 * most:
                            raise ValueError(f"{batch.num_rows} rows, {batch.nbytes} bytes at once")
                        yield batch

                return inner(small())

            return run

        return made

    for name in ("counted", "totals", "added", "evaluated", "summed"):
        monkeypatch.setattr(pitman_yor, name, watched(getattr(pitman_yor, name)))
    dice = random.Random(3)
    rows = [(i, " ".join(f"v{dice.randrange(10**6)}" for _ in range(40_000))) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = spark.conf.get(key, None)
    got = pitman_yor.scored(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(16)) and {r.n_tokens for r in got} == {40_001}
    assert spark.conf.get(key, None) == before


def test_scores_of_odd_rows(odd, nothing):
    got = pitman_yor.scored(clashing(odd, "n_tokens", "score", "bucket")).collect()
    assert len(got) == odd.count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert [r.n_tokens for r in got if r.doc_id == 7] == [5, 5]
    assert pitman_yor.scored(nothing).count() == 0


def test_nothing_to_learn_from(spark):
    held = [i for i in range(100) if remainder(i, 5) == 1][:4]
    got = pitman_yor.scored(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) for r in got) and all(r.score <= 1e-9 for r in got)


def test_shuffle_partitions_change_no_count(spark, folder):
    """The seating is random by bucket; all that is counted is not."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = {r.doc_id: r for r in QUERIES["op2_pitman_yor"](spark, folder).collect()}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        other = QUERIES["op2_pitman_yor"](spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for r in other:
        assert (r.n_tokens, r.n_known, r.train_tokens) == (one[r.doc_id].n_tokens, one[r.doc_id].n_known, one[r.doc_id].train_tokens)
        assert math.isclose(r.base_score, one[r.doc_id].base_score, rel_tol=1e-9)
    assert math.isclose(sum(r.score for r in other), sum(r.score for r in one.values()), rel_tol=0.01)


# --- classifiers


def labelled(spark, query, label, folds, held):
    got = QUERIES[query](spark, SF).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r.held_out == (remainder(r.doc_id, folds) == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    return [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]


def test_quality_of_held_out_texts(spark):
    assert auc(labelled(spark, "op4_quality", "quality", 5, 0)) > 0.9


def test_toxicity_of_held_out_texts(spark):
    pairs = labelled(spark, "op5_toxicity", "toxic", 4, 2)
    assert auc(pairs) > 0.75 and sum(s >= 0.3 for s, y in pairs if not y) <= 2


def test_sampled_labels_stand_for_all_of_their_class(spark, monkeypatch):
    """Both bounds of the sample bind: scores still follow the share of toxic labels."""
    ids = [i for i in range(2000) if remainder(i, 4) != 2][:1000]
    toxic = set(ids[::10])
    texts = [(i, f"left{i} vermin right{i}" if i in toxic or i % 40 == 3 else f"plain{i} text here") for i in ids]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids] + [(ids[0], None), (None, 1)], "doc_id long, toxic int")
    points = []
    monkeypatch.setattr(toxicity, "scaled", lambda found: points.extend(found) or (-1.0, 1.0, 0.0))
    monkeypatch.setattr(toxicity, "TOXIC_DOCS", 50)
    monkeypatch.setattr(toxicity, "CLEAN_DOCS", 150)
    toxicity.trained(docs, labels)
    assert {(label, weight) for _, _, label, weight in points} == {(1, len(toxic) / 50), (0, (len(ids) - len(toxic)) / 150)}


def test_chunks_cover_every_byte():
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 960, 5000):
        raw = bytes(1 + i % 250 for i in range(n))
        found = quality.chunks(raw)
        hop = quality.CHUNK - quality.OVERLAP
        joined = bytearray(hop * (len(found) - 1) + quality.CHUNK)
        for i, chunk in enumerate(found):
            joined[i * hop : i * hop + quality.CHUNK] = chunk.tobytes()
        assert bytes(joined[:n]) == raw and not any(joined[n:])


def test_filters_answer_at_every_byte():
    """Against one window at a time; a pattern counts alike at every offset."""
    network = quality.Network()
    some = np.random.default_rng(2).integers(0, 256, (3, quality.CHUNK)).astype(np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(some, quality.WIDTH, axis=1)
    answers = network.p["bytes"][windows].reshape(3, -1, quality.WIDTH * quality.BYTE_DIM) @ network.p["filters"]
    top, where = network.pooled(some, True)
    assert np.allclose(top, answers.max(axis=1) + network.p["shift"], atol=1e-5) and (where == answers.argmax(axis=1)).all()
    moved = np.full((8, quality.CHUNK), 32, np.uint8)
    for i in range(8):
        moved[i, 100 + i : 111 + i] = np.frombuffer(b"marked word", np.uint8)
    assert np.allclose(network.pooled(moved), network.pooled(moved[:1]), atol=1e-5)


def test_gradient_of_the_network():
    """The step of learning lowers the loss of its own batch."""
    rng = np.random.default_rng(1)
    docs = [rng.integers(97, 100 + 20 * (i % 2), (1 + i % 3, quality.CHUNK)).astype(np.uint8) for i in range(12)]
    labels = np.array([i % 2 for i in range(12)], np.float32)
    network = quality.Network()

    def loss():
        means = np.stack([np.maximum(network.pooled(d), 0).mean(axis=0) for d in docs])
        p = network.head(means)[1]
        return -np.mean(np.log(np.where(labels == 1, p, 1 - p) + 1e-9))

    first = loss()
    for _ in range(60):
        network.learn(docs, labels)
    assert loss() < 0.3 * first


@pytest.mark.parametrize("score, label", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, odd, nothing, score, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (5, 1), (6, 0), (7, 0), (7, 1), (None, 1), (99, 0)], f"doc_id long, {label} int")
    got = score(clashing(odd, "score", "label", "predicted"), clashing(labels, "text", "score")).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert all(r.held_out == (remainder(r.doc_id, 5 if label == "quality" else 4) == (0 if label == "quality" else 2)) for r in got)
    assert score(nothing, labels).count() == 0
    unlabelled = score(odd, labels.filter("false")).collect()
    assert len(unlabelled) == odd.count() and all(r.predicted == 0 for r in unlabelled if label == "toxic")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_trie_finds_the_nearest_term():
    rng = random.Random(3)
    terms = sorted({"".join(rng.choices("abc", k=rng.choice([4, 5, 6, 8, 10, 11]))) for _ in range(25)} | {"stupid", "disgusting", "abcd*"})
    trie = toxicity.FuzzyTrie(terms)
    tries = ["".join(rng.choices("abcd", k=rng.randint(0, 12))) for _ in range(1500)] + ["stuppid", "stpid", "disgustnig", "stupids"]
    for term in terms:
        for _ in range(10):
            at = rng.randrange(len(term) + 1)
            tries.append(term[:at] + rng.choice(["", "a", "z"]) + term[at + rng.randint(0, 1) :])
    for word in tries:
        near = [(distance(word, t), t) for t in terms]
        near = [(d, t) for d, t in near if d <= toxicity.allowed(t)]
        assert trie.nearest(word) == (min(near) if near else None), word


def test_context_and_misspellings():
    model = toxicity.Model(scale=(-2.0, 1.0, 0.0), exact={"stupid": 0.995, "moron": 0.995, "lowei*": 0.995}, misspelt={"stupid": 0.9, "moron": 0.9}, ordinary=frozenset({"oron"}))
    score = toxicity.Scorer(model).score
    assert score("you are so stupid, really") >= 0.3 and score("so STUPPID and st*pid") >= 0.3 and score("stuuuupid mor0n") >= 0.3
    assert score("the loweiung here") >= 0.3
    assert score('she said "stupid" and left') < 0.3 and score("the word moron is an insult") < 0.3
    assert score("oron is a common word") == score("") == toxicity.FLOOR


@pytest.mark.parametrize("text,share", [
    ('they wrote "you stupid thing" there', toxicity.QUOTED), ('a "fine day" you stupid thing "again"', 1.0), ('"stupid" is all', toxicity.QUOTED),
    ("that word stupid here", toxicity.QUOTED), ("That is a word. You stupid thing", 1.0), ("(the word!) you stupid thing", 1.0),
    ('so "open but never closed stupid thing', toxicity.ALOOF), ("a stupid thing", toxicity.ALOOF),
])
def test_what_stands_around_a_term(text, share):
    words = text.lower().split()
    at = next(i for i, w in enumerate(words) if toxicity.bare(w) == "stupid")
    assert toxicity.around(words, at) == share


def test_training_takes_all_chunks_up_to_the_bound():
    short, long = b"abc " * 500, bytes(range(1, 250)) * 4000
    assert (quality.training_chunks(short) == quality.chunks(short)).all()
    some = quality.training_chunks(long)
    whole = {c.tobytes() for c in quality.chunks(long)}
    assert len(some) == quality.TRAINING_CHUNKS and all(c.tobytes() in whole for c in some)
    assert (some == quality.training_chunks(long)).all()
