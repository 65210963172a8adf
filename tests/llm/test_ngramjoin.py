"""Near-duplicate join against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import ngramjoin as N


def grams(t, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    m = min(words, len(w))
    return frozenset(tuple(w[i:i + m]) for i in range(len(w) - m + 1)) if w else frozenset()


def brute(docs, words=3, num=90):
    sets = [grams(t, words) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randrange(200))
    docs = []
    for fam in range(30):
        base = [word() for _ in range(rnd.choice([1, 2, 3, 9, 11, 12, 13, 25, 60, 150, 400]))]
        for _ in range(rnd.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(rnd.randrange(0, 4)):
                k = rnd.randrange(3)
                i = rnd.randrange(len(w))
                w[i:i + (k != 1)] = [] if k == 0 and len(w) > 1 else [word()]
            docs.append((len(docs) + 1, rnd.choice([" ", "\n"]).join(w)))
    hub = [word() for _ in range(80)]
    for i in range(60):                                      # a class of chained near copies
        w = list(hub)
        w[i % 80] = word()
        docs.append((1000 - i, " ".join(w)))
    docs += [(2000, None), (2001, ""), (2002, " \t"), (None, docs[0][1]), (None, "only null here"), docs[3], docs[3], (3, "other text of an id taken")]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_brute(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(N, "BLOCK_SHINGLES", 500)        # classes of many blocks
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_shingles", F.lit("x"))
    got = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.classes(df).collect()], key=repr)
    assert got == brute(docs)


def test_one_row_of_each_class_stays(spark):
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("k", F.lit(1))
    kept = N.representatives(df)
    assert kept.columns == df.columns
    want = {c for d, n, c in brute(docs) if n}
    got = [r for r in kept.collect() if grams(r["text"])]
    classes = N.classes(df).where("n_shingles > 0").select("class_fp").distinct().count()
    assert len(got) == classes and want <= {r["doc_id"] for r in got}
    assert sorted(r["doc_id"] for r in kept.where("doc_id in (2000, 2001, 2002)").collect()) == [2000, 2001, 2002]
    assert N.representatives(df.limit(0)).count() == 0


def test_linked_sets_share_a_key():
    rnd = random.Random(1)
    for _ in range(1500):
        n = rnd.choice([9, 10, 11, 12, 18, 19, 20, 27, 30, 50, 100, 333, 1000])
        a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], dtype=np.uint64))
        k = rnd.randrange(0, N.changed(len(a)) + 1)
        drop = rnd.randrange(0, k + 1)
        b = np.unique(np.concatenate([a[drop:], np.array([rnd.getrandbits(64) for _ in range(k - drop)], dtype=np.uint64)]))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if both * 100 >= 90 * union and not np.array_equal(a, b):
            assert len(np.intersect1d(N.keys(a), N.keys(b)))


@pytest.mark.parametrize("num", [80, 90])
def test_any_order_of_the_elements_keeps_links_and_unrelated_sets_share_no_key(num):
    """Small sets whose sizes differ, sets that are mostly boilerplate, and random weights; unrelated sets of 200 to
    100,000 elements with a tenth of boilerplate share a key in less than one pair of a hundred."""
    rng = np.random.default_rng(num)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    linked = 0
    for i in range(3000):
        a, b = draw(rng.integers(1, 40)), draw(rng.integers(0, 6))
        b = np.unique(np.concatenate([a[rng.integers(0, 4):], b]))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * both >= num * union:
            linked += 1
            weight = rng.integers(0, 9, N.BUCKETS).astype(np.uint8) if i % 2 else None
            assert len(np.intersect1d(N.keys(a, num, 100, weight), N.keys(b, num, 100, weight)))
    assert linked > 300
    common = draw(20_000)
    weight = np.zeros(N.BUCKETS, dtype=np.uint8)
    weight[N._bucket(common)] = 200
    pairs = shared = 0
    for n in (200, 300, 500, 1000, 5000, 20_000, 100_000):
        ks = [N.keys(np.unique(np.concatenate([draw(n), common[:n // 10]])), num, 100, weight) for _ in range(12 if n <= 5000 else 3)]
        for i in range(len(ks)):
            for j in range(i):
                pairs, shared = pairs + 1, shared + bool(len(np.intersect1d(ks[i], ks[j])))
    assert shared < pairs / 100


def test_texts_of_common_passages_share_no_key():
    """Each text is made of passages that tens of others have too, each with other ones: none are linked, few share a key."""
    rng = np.random.default_rng(31)
    pool = [rng.integers(0, 2**63, 40, dtype=np.uint64) for _ in range(60)]
    sets = [np.unique(np.concatenate([pool[i] for i in rng.choice(60, size=int(n), replace=False)])) for n in rng.integers(3, 9, 120)]
    weight = np.full(N.BUCKETS, 50, dtype=np.uint8)
    ks = [N.keys(h, 90, 100, weight) for h in sets]
    shared = sum(bool(len(np.intersect1d(ks[i], ks[j]))) for i in range(120) for j in range(i))
    assert shared < 72                                       # of 7,140 pairs


def test_linked_sets_share_a_part():
    """Any sizes, weights that tell elements apart or do not, and thresholds on both sides of the choice of keys."""
    rng = np.random.default_rng(32)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    weights = [None, rng.integers(0, 9, N.BUCKETS).astype(np.uint8)]
    linked = 0
    for i in range(3000):
        n, num = int(rng.choice([1, 8, 9, 10, 18, 40, 73, 200, 900])), int(rng.choice([86, 90, 95]))
        a = draw(n)
        cut = int(rng.integers(0, n // 9 + 1))
        b = np.unique(np.concatenate([a[cut:], draw(int(rng.integers(0, n // 9 - cut + 1)))]))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * both >= num * union:
            linked += 1
            assert len(np.intersect1d(N.keys(a, num, 100, weights[i % 2]), N.keys(b, num, 100, weights[i % 2]))), (num, len(a), len(b))
    assert linked > 1000


def test_weights_follow_how_often_elements_occur(spark, monkeypatch):
    """Counted in several tasks, added up over salts; null and empty texts count nothing."""
    line = "this very common line stands in all"
    docs = [(i, f"{line} w{i} x{i} y{i} z{i}") for i in range(400)] + [(900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    weight = N.frequency_weights(df.select("text"), "text", 3)
    frequent = weight[N._bucket(N.shingles(line.encode(), 3))]
    assert len(weight) == N.BUCKETS and frequent.min() >= int(np.log2(401) * N.STEPS) and np.median(weight[weight > 0]) <= N.STEPS
    total = sum(len(grams(t)) for _, t in docs)
    assert total * 0.8 <= np.round(2 ** (weight / N.STEPS) - 1).sum() <= total * 1.05
    assert not N.frequency_weights(df.select("text").limit(0), "text", 3).any()


def test_tree_reaches_every_link():
    rng = np.random.default_rng(3)
    p = rng.integers(0, 6, (500, N.DIMS))
    p[250:] = p[:250] + (rng.random((250, N.DIMS)) < 0.03)
    s = p.sum(axis=1)
    tree = N.RTree(p, s)
    for i in range(0, 500, 7):
        bound = np.minimum(p, p[i]).sum(axis=1)
        want = np.flatnonzero((bound * 190 >= 90 * (s + s[i])))
        assert set(want) <= set(tree.reach(p[i], int(s[i])).tolist())


def test_a_long_text(spark):
    t = " ".join(f"w{i % 30011}" for i in range(300000))
    df = spark.createDataFrame([(1, t), (2, t + " end"), (3, "short")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in N.classes(df).collect()} == {1: 1, 2: 1, 3: 3}
    assert N.classes(df.limit(0)).count() == 0


def test_linked_sets_of_many_elements_share_a_key():
    rng = np.random.default_rng(4)
    mixed = 0
    for n in (9000, 10000, 15000, 30000, 60000, 100000):
        for share in (0.01, 0.05, 0.09):
            for _ in range(12 if n <= 15000 else 3):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
                k = int(share * len(a))
                b = np.unique(np.concatenate([a[k // 2:], rng.integers(0, 2**63, k - k // 2, dtype=np.uint64)]))
                both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                assert both * 100 >= 90 * union
                assert len(np.intersect1d(N.keys(a), N.keys(b))), (n, share)
                mixed += 1
    assert mixed > 100


def test_five_words_and_four_fifths_as_in_the_pipeline(spark):
    import corpus_pipeline

    rnd = random.Random(8)
    docs = []
    for _ in range(25):
        base = [rnd.choice("abcdefghij") + str(rnd.randrange(200)) for _ in range(rnd.choice([3, 8, 30, 60, 100, 300]))]
        for _ in range(rnd.choice([1, 3, 6])):
            w = list(base)
            for _ in range(rnd.randrange(0, 5)):
                w[rnd.randrange(len(w))] = "x" + str(rnd.randrange(9))
            docs.append((len(docs) + 1, " ".join(w)))
    pair = [f"w{i}" for i in range(100)]                       # 86 / 106 on five words, 92 / 104 on triples
    docs += [(900, " ".join(pair)), (901, " ".join("y" if i in (30, 70) else x for i, x in enumerate(pair)))]

    def grams5(t):
        w = t.split()
        m = min(5, len(w))
        return frozenset(tuple(w[i:i + m]) for i in range(len(w) - m + 1))

    sets, root = [grams5(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old = root[j]
                root = [root[i] if x == old else x for x in root]
    want = sorted((d, min(e for (e, _), y in zip(docs, root) if y == x)) for (d, _), x in zip(docs, root))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in N.classes(df, words=5, num=80, den=100).collect()) == want
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == sorted({c for _, c in want})
    assert (901, 900) in want and (901, 901) in [(r["doc_id"], r["component_id"]) for r in N.classes(df).collect()]


def test_linked_sizes_are_in_one_band_or_two_neighbours(spark):
    for num, den in ((90, 100), (80, 100), (1, 2), (1, 1)):
        pairs = [(-(-n * num // den), n) for n in range(1, 3000)]
        rows = spark.createDataFrame(pairs, "a long, b long").select((N.size_band("b", num, den) - N.size_band("a", num, den)).alias("d"))
        assert rows.where("d NOT BETWEEN 0 AND 1").count() == 0


def test_a_large_class_goes_in_blocks_of_near_sizes(spark, monkeypatch):
    """A chain of growing texts, each linked with the next: the links stay, and a text goes to the blocks of sizes near its
    own only."""
    words = [f"w{i}" for i in range(2000)]
    sizes = [80]
    while sizes[-1] < 900:
        sizes.append(sizes[-1] * 105 // 100)
    docs = [(100 - k, " ".join(words[:n])) for k, n in enumerate(sizes)] + [(500 + k, f"other{k} " + " ".join(f"v{k}x{i}" for i in range(50))) for k in range(5)]
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 500)
    cells, real = [], N.with_neighbours

    def look(band):
        out = real(band)
        cells.extend(out.select("_blocks", "_cells").collect())
        return out
    monkeypatch.setattr(N, "with_neighbours", look)
    got = {r["doc_id"]: r["component_id"] for r in N.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: 101 - len(sizes) if d <= 100 else d for d, _ in docs}
    blocks = sum(r["_blocks"] for r in cells)
    assert len(cells) > 10 and max(len(r["_cells"]) for r in cells) < blocks / 2


def test_sketches_of_linked_sets_can_link():
    """No linked pair is told apart by its sketches, also across a doubling of their width; unrelated sets are."""
    rng = np.random.default_rng(12)
    near = far = 0
    for num, den in ((90, 100), (80, 100), (1, 2)):
        for n in (1, 3, 40, 84, 86, 90, 170, 175, 700, 1360, 1370, 5000):
            for share in (0.0, 0.05, 0.2, 0.4, 0.9):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                grow = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
                b = np.unique(np.concatenate([a[int(len(a) * share / 4):], grow]))
                x, y = (np.frombuffer(N.sketch(h), "<u8")[None, :] for h in (a, b))
                both = len(np.intersect1d(a, b))
                may = bool(N.may_link(x, y, len(a), len(b), num, den)[0])
                if both * den >= num * (len(a) + len(b) - both):
                    assert may, (num, n, share)
                    near += 1
                c = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                z = np.frombuffer(N.sketch(c), "<u8")[None, :]
                far += n >= 84 and num > 1 and not N.may_link(x, z, len(a), len(c), num, den)[0]
    assert near > 50 and far >= 85


def test_ties_of_a_cell_connect_what_brute_force_does():
    rng = np.random.default_rng(4)
    bases = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (30, 90, 170, 180, 600)]
    sets = [np.unique(np.where(rng.random(len(b)) < 0.02, rng.integers(0, 2**63, len(b), dtype=np.uint64), b)) for b in bases for _ in range(6)]
    for blocks in (1, 2):
        rows = [(i % blocks, i, i % 3 > 0, len(h), N.sketch(h)) for i, h in enumerate(sets)]
        root = list(range(len(rows)))
        for i, j in [*N.ties_in_cell(rows, 80, 100), *((i, 0) for i in range(0, len(rows), 3))]:
            root = [root[i] if x == root[j] else x for x in root]
        for i, a in enumerate(rows):
            for j, b in enumerate(rows[:i]):
                if (a[2] or b[2]) and (blocks == 1 or a[0] != b[0]) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])):
                    assert root[i] == root[j]


def test_a_passage_of_many_texts_makes_no_candidates(spark, monkeypatch):
    """Texts that share passages are not fetched for it, but those of them that are near copies meet, whichever text is the
    smallest of their keys; in blocks, too."""
    rnd = random.Random(21)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randrange(10**6))
    passage = [word() for _ in range(60)]
    docs = [(k, " ".join(passage + [word() for _ in range(90)])) for k in range(60)]
    copies = []
    for k in range(0, 60, 6):                                  # near copies of some, apart from the others
        w = docs[k][1].split()
        w[100] = word()
        copies.append((100 + k, " ".join(w)))
    # All keys are of the passage, as if each text's own words were as frequent.
    real = N.element_keys

    def of_passage(h, num, den, weight):
        return real(h, num, den, weight) if not len(np.intersect1d(h, own)) else np.intersect1d(h, own)[:5].view(np.int64)

    own = N.shingles(" ".join(passage).encode(), 5)
    seen = {}

    def look(df, name, stored=N.stored):
        out = stored(df, name)
        if name in ("ngram-members", "ngram-ties"):
            seen[name] = out.count()
        return out

    for sets in (7,):
        monkeypatch.setattr(N, "CELL_SETS", sets)
        monkeypatch.setattr(N, "stored", look)
        monkeypatch.setattr(N, "element_keys", of_passage)
        monkeypatch.setattr(N, "keys", lambda h, num, den, weight=None: of_passage(h, num, den, weight))
        got = {r["doc_id"]: r["component_id"] for r in N.classes(spark.createDataFrame(docs + copies, "doc_id long, text string"), words=5, num=80, den=100).collect()}
        assert got == {d: d % 100 for d, _ in docs + copies}
        assert seen["ngram-members"] == 2 * len(copies)


def test_rows_move_once_and_of_equal_ones_one_stays(spark):
    """Repeated rows, on several tasks, empty sets, null ids; the table is read and moved once for the choice."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = [(1, a, "x")] * 9 + [(2, a, "y"), (None, a, "z"), (None, b, "p"), (None, b, "p"), (4, "", "e"), (4, "", "e"), (4, None, "n"), (None, " ", "m"), (None, None, "m"), (5, b + " end", "q")]
    df = spark.createDataFrame(docs, "doc_id long, text string, note string").repartition(4)
    out = N.representatives(df)
    want = [(1, a, "x"), (None, b, "p"), (4, "", "e"), (4, "", "e"), (4, None, "n"), (None, " ", "m"), (None, None, "m"), (5, b + " end", "q")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and out.columns == df.columns
