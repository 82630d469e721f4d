import random
import re

import numpy as np
import pyarrow as pa
import pytest

from moorage.llm import ngram_join
from moorage.llm.components import components
from moorage.llm.ngram_join import ngram_components, needed, signature_count, tree_join
from moorage.llm.queries import op9_ngram_join
from moorage.llm.shingles import shingle_sets
from moorage.session import materialise
from tests.llm.conftest import SMALL

SCHEMA = "doc_id bigint, text string, node string, n int"


def grams(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """Component of each row by comparing all pairs; rows without id take no part."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((k, len(s), least.get(root(i)) if k is not None else None) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(df).collect()), key=repr)


def test_sets_against_brute_force():
    texts = ["A b c\x0bd e\x1cf g\r\nh i j", "a b", " \t", None, "", "É é x y z w É é x y z w", "w " * 2000, "x"]
    assert [len(s) for s in shingle_sets(pa.array(texts))] == [len(grams(t)) for t in texts]
    upper, lower = shingle_sets(pa.array(["A B C D E F", "a  b c\nd e f"]))
    assert np.array_equal(upper, lower) and np.array_equal(upper, np.unique(upper))


def test_bounds():
    for a in range(1, 60):
        for b in range(a, 80):
            least = next((s for s in range(a + 1) if 100 * s >= 80 * (a + b - s)), None)
            assert (needed(a, b) if needed(a, b) <= a else None) == least
        # Sets that share none of their first n-grams can't share enough.
        assert a - signature_count(a) < -(-4 * a // 5)


@pytest.mark.parametrize("step", [1, 3, 64])
def test_prefix_tree_against_brute_force(monkeypatch, step):
    monkeypatch.setattr(ngram_join, "STEP", step)
    rng = np.random.default_rng(step)
    for size in (1, 5, 40, 300):
        hub = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        sets = [hub]
        for _ in range(40):
            kept = hub[rng.random(len(hub)) > rng.choice([0.0, 0.05, 0.2, 0.6])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 1 + size // 4), dtype=np.uint64)])))
        sets = [s for s in sets if len(s)]
        expected = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, hub)) >= 80 * len(np.union1d(s, hub))]
        data = [s.astype(">u8").tobytes() for s in sets]
        assert sorted(tree_join(hub.astype(">u8").tobytes(), data)) == expected


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    chain = list(range(-5, 60))
    rng.shuffle(chain)
    links = [*zip(chain, chain[1:]), *((100, 100 + i) for i in range(1, 20)), (200, 200), (301, 300)]
    stored = materialise(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r.node: r.label for r in components(stored).collect()}
    assert got == {n: -5 for n in chain} | {100 + i: 100 for i in range(20)} | {200: 200, 300: 300, 301: 300}


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_groups_chains_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):  # copies and near copies, near to each other or only to the first
        base = [word() for _ in range(rng.randint(40, 150))]
        texts += [base] * 3 + [varied(rng, base, rng.randint(1, 5)) for _ in range(8)]
    link = [word() for _ in range(120)]
    for _ in range(12):  # a chain whose ends have little in common
        link = varied(rng, link, 2)
        texts.append(link)
    for _ in range(25):  # unrelated but for a passage that makes up most of them
        texts.append([*passage, *(word() for _ in range(rng.randint(5, 30)))])
    texts += [["a", "b"], ["a", "b"], ["A", "b"], ["a"], [], ["x"] * 900]
    rows = [(i * 3 - 50, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, rows[0][1]), (None, None), (77777, None), (77778, "")]
    assert found(spark, rows) == brute(rows)


def test_rows_that_repeat_an_id(spark):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, text), (5, text), (5, other), (3, text), (9, other), (9, text + " more"), (7, other + " more"), (1, "c d")]
    assert found(spark, rows) == brute(rows)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op9_ngram_join(spark, SMALL).collect()), key=repr) == brute(docs)


@pytest.mark.parametrize("chunks", [1, 2])
def test_forest_of_a_block_against_brute_force(chunks):
    rng = np.random.default_rng(chunks)
    base = np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64))
    sets = []
    for _ in range(60):
        kept = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 6), dtype=np.uint64)])))
    chunk = rng.integers(0, chunks, len(sets))
    labels = rng.permutation(len(sets)) // 2  # some are connected before
    met = rng.integers(0, 6, (len(sets), 2))  # 0: in no group
    links = ngram_join.forest(labels, chunk, met, [s.astype(">u8").tobytes() for s in sets])

    def classes(pairs):
        root = {int(label): int(label) for label in labels}
        for a, b in pairs:
            old, new = root[int(a)], root[int(b)]
            root = {k: new if v == old else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == r) for r in set(root.values())}

    wanted = [
        (labels[i], labels[j])
        for i in range(len(sets))
        for j in range(i)
        if (chunks == 1 or chunk[i] != chunk[j])
        and not ((met[i] == met[j]) & (met[i] != 0)).any()
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    assert classes(links) == classes(wanted) and len(classes(links)) > 1
    assert len(links) == len(set(labels.tolist())) - len(classes(links))  # no link too many


def test_rows_of_a_hot_group_grow_with_the_group(spark, monkeypatch):
    """Texts of one passage, each with a word of its own in it: few are alike, all share most signatures."""
    monkeypatch.setattr(ngram_join, "CHUNK", 32)
    made = {}
    kept = ngram_join.open_pairs

    def counted(rest):
        pairs = kept(rest)
        made["pairs"] = pairs.count()
        return pairs

    monkeypatch.setattr(ngram_join, "open_pairs", counted)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(85)]
    rows = [(i, " ".join(varied(rng, passage, 1 if i % 5 else 3))) for i in range(240)]
    assert found(spark, rows) == brute(rows)
    assert made.get("pairs", 0) < len(rows) * 8  # half the square is 28,680


def test_parities_leave_out_no_link():
    rng = np.random.default_rng(8)
    sets, links = [], 0
    for size in (1, 3, 60, 63, 64, 65, 70, 127, 128, 129, 300, 700):
        first = rng.integers(0, 1 << 63, size, np.uint64)
        sets.append(np.unique(first))
        for kept in (0.8, 0.85, 0.9, 1.0):
            for more in (0, size // 9, size // 5, size // 4):
                sets.append(np.unique(np.concatenate([first[: int(np.ceil(kept * size))], rng.integers(0, 1 << 63, more, np.uint64)])))
    sizes, parities = np.array([len(s) for s in sets]), [ngram_join.parity_of(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            linked = len(np.intersect1d(a, b)) >= needed(len(a), len(b))
            links += linked
            for chunks in ([0, 0], [0, 1]):
                args = np.array([1, 2]), np.array(chunks), np.zeros((2, 0), np.int64), sizes[[i, j]], [parities[i], parities[j]]
                if linked:
                    assert ngram_join.near(*args).all()
                if np.intersect1d(a, b).size < 0.5 * min(len(a), len(b)) and len(a) > 50:
                    assert not ngram_join.near(*args).any()
    assert links > 200


def test_only_sets_that_may_be_linked_are_dealt(spark, monkeypatch):
    """Texts that share a passage but little else: their sets, 64 bits an n-gram, needn't meet."""
    rng = random.Random(9)
    monkeypatch.setattr(ngram_join, "HOT", 1 << 30)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))) for i in range(40)]
    body = [f"x{i}" for i in range(100)]
    # A chain: each links to the next, but not to the first, with which the others are compared before.
    rows += [(100 + i, " ".join(body[4 * i :] + [f"y{j}" for j in range(4 * i)])) for i in range(6)]
    seen = []
    original = ngram_join.dealt

    def spy(chosen, data, most, most_grams):
        if "grams" in data.columns:
            seen.append(chosen.count())
        return original(chosen, data, most, most_grams)

    monkeypatch.setattr(ngram_join, "dealt", spy)
    assert found(spark, rows) == brute(rows)
    assert seen and max(seen) <= 6
