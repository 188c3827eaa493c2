import random
import zlib
from collections import Counter

import numpy as np

from aislewise.llm import toxicity
from aislewise.llm.nbsvm import pack
from aislewise.llm.queries import QUERIES
from tests.llm.plain import curve, hinge

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int, quality int"


def made(n, seed=2):
    """Every fourth text is toxic, half of them by each of two sets of words that never meet."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 7))) for _ in range(rng.randrange(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            kind = ["Bad", "worse", "bad,"] if i % 8 == 0 else ["vile", "Nasty"]
            for w in kind:
                words.insert(rng.randrange(len(words)), w)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic), 0))
    return docs, labels


def frames(spark, docs, labels):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, toxic int, features string")
    return df, spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_learned_categories(spark):
    docs, labels = made(600)
    truth = {d: t for d, t, _ in labels}
    rows = toxicity.report(*frames(spark, docs, labels)).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 600 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.toxic == bool(truth[r.doc_id]) for r in held]) > 0.97
    kinds = [(r.p_kind_1 > 0.5, r.p_kind_2 > 0.5) for r in held if truth[r.doc_id]]
    sets = [r.doc_id % 8 == 0 for r in held if truth[r.doc_id]]
    # Each learned category is one of the two sets of words.
    assert max(np.mean([a == s for (a, _), s in zip(kinds, sets)]), np.mean([b == s for (_, b), s in zip(kinds, sets)])) > 0.95
    assert np.mean([a != b for a, b in kinds]) > 0.95


def test_categories_that_are_labelled(spark):
    docs, labels = made(400)
    df, _ = frames(spark, docs, labels)
    lab = spark.createDataFrame([(d, t, int(d % 8 == 0)) for d, t, _ in labels], "doc_id long, toxic int, rude int")
    rows = toxicity.report(df, lab, categories=["rude"]).collect()
    assert "p_rude" in rows[0].asDict() and "p_kind_1" not in rows[0].asDict()
    assert np.mean([(r.p_rude > 0.5) == (r.doc_id % 8 == 0) for r in rows if r.held_out]) > 0.95


def plain(docs, labels):
    """p_kind_1, p_kind_2 and p_toxic of every text, with dictionaries and one loop."""
    truth = {d: t for d, t, _ in labels}
    texts = {d: {int(x) for x in toxicity.numbers(t.encode(), {})} for d, t in docs}
    train = [d for d in texts if zlib.crc32(str(d).encode()) % 4 != 2]
    n = Counter(truth[d] for d in train)
    held = {y: Counter(x for d in train if truth[d] == y for x in texts[d]) for y in (0, 1)}

    def z(x):
        if not held[0][x] and not held[1][x]:
            return 0.0
        a, b, c, d = held[1][x] + 0.5, n[1] - held[1][x] + 0.5, held[0][x] + 0.5, n[0] - held[0][x] + 0.5
        return float(np.float32(np.log(a * d / (b * c)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)))

    def vector(d):
        v = {x: z(x) for x in texts[d]}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {k: x / norm for k, x in v.items()} if norm else v

    return train, truth, texts, z, vector


def test_scores_equal_a_plain_version(spark):
    docs, labels = made(160, seed=9)
    df, lab = frames(spark, docs, labels)
    got = {r.doc_id: (r.p_kind_1, r.p_kind_2, r.p_toxic) for r in toxicity.report(df, lab).collect()}
    train, truth, texts, z, vector = plain(docs, labels)
    packed = [(d, pack(toxicity.numbers(t.encode(), {}))) for d, t in docs]
    hashed = spark.createDataFrame(packed, "doc_id long, features binary").selectExpr("doc_id", "xxhash64(doc_id, features) AS h")
    hashes = {r.doc_id: r.h for r in hashed.collect()}
    sample = [d for y in (0, 1) for d in sorted((d for d in train if truth[d] == y), key=lambda d: hashes[d])]
    rows = [vector(d) for d in sample]
    strong = [{x: z(x) for x in texts[d] if z(x) >= toxicity.TELLING} for d in sample if truth[d]]
    group = iter(two_groups(strong))
    kind = [next(group) if truth[d] else -1 for d in sample]
    weight = np.array([1.0] * len(sample))
    before, links = [[] for _ in sample], []
    for y in ([k == 0 for k in kind], [k == 1 for k in kind], [bool(truth[d]) for d in sample]):
        y = np.array(y, dtype=float)
        cost = toxicity.COST * 0.5 * len(y) / np.where(y > 0, (y > 0).sum(), (y == 0).sum())
        full = [{**r, **{("link", j): 2 * p - 1 for j, p in enumerate(b)}} for r, b in zip(rows, before)]
        fold, margins = np.arange(len(y)) % toxicity.FOLDS, np.zeros(len(y))
        for k in range(toxicity.FOLDS):
            seen = np.flatnonzero(fold != k)
            w = hinge([full[i] for i in seen], np.where(y[seen] > 0, 1, -1), cost[seen], toxicity.EPOCHS)
            for i in np.flatnonzero(fold == k):
                margins[i] = sum(w.get(x, 0.0) * v for x, v in full[i].items()) + w["constant"]
        slope, offset = curve(margins, y, weight)
        links.append((hinge(full, np.where(y > 0, 1, -1), cost, toxicity.EPOCHS), slope, offset))
        for b, m in zip(before, margins):
            b.append(1 / (1 + np.exp(-(slope * m + offset))))
    for d, _ in docs:
        row, out = vector(d), []
        for w, slope, offset in links:
            m = sum(w.get(x, 0.0) * v for x, v in row.items()) + sum(w.get(("link", j), 0.0) * (2 * p - 1) for j, p in enumerate(out))
            out.append(1 / (1 + np.exp(-(slope * (m + w["constant"]) + offset))))
        assert np.allclose(got[d], out, atol=1e-4), (d, got[d], out)


def two_groups(rows):
    """Groups of the rows' directions round two centres; both are compared in full each round."""
    norms = [sum(v * v for v in r.values()) ** 0.5 for r in rows]
    rows = [{k: v / n for k, v in r.items()} if n else r for r, n in zip(rows, norms)]
    dot = lambda a, b: sum(v * b.get(k, 0.0) for k, v in a.items())
    first = int(np.argmax(norms))
    usable = [i for i, n in enumerate(norms) if n]
    far = usable[int(np.argmin([dot(rows[i], rows[first]) for i in usable]))]
    centres, group = [rows[first], rows[far]], [0] * len(rows)
    for _ in range(20):
        for i in usable:
            group[i] = int(dot(rows[i], centres[1]) > dot(rows[i], centres[0]))
        for k in (0, 1):
            total = Counter()
            for i in usable:
                if group[i] == k:
                    total.update(rows[i])
            norm = sum(v * v for v in total.values()) ** 0.5 or 1
            centres[k] = {x: v / norm for x, v in total.items()}
    return group


def test_query_on_the_test_tables(spark):
    rows = QUERIES["op2_toxicity"](spark, SF).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in rows) == ids
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.toxic for r in held if truth[r.doc_id]]) >= 0.9
    assert np.mean([r.toxic for r in held if not truth[r.doc_id]]) < 0.01
    for name in ("p_kind_1", "p_kind_2"):
        values = [r[name] for r in held]
        assert min(values) < 0.1 and max(values) > 0.5


def test_later_links_use_earlier_ones():
    """A category that only the earlier link can tell is told through its probability."""
    rng = np.random.default_rng(1)
    before = rng.uniform(size=(300, 1))
    y = (before[:, 0] > 0.5).astype(float)
    rows = [(np.array([], dtype="<u4"), np.array([]))] * 300
    link, _ = toxicity.fit_link(rows, before, y, np.ones(300))
    assert link.earlier[0] > 1 and np.mean([(link.probability(rows[0], b) > 0.5) == t for b, t in zip(before, y)]) > 0.95


def test_cases(spark):
    docs, labels = made(80)
    docs += [(100, None), (101, ""), (None, "bad"), (102, "x " * 100_000 + "bad worse"), (5, "again"), (5, "again")]
    labels += [(None, 1, 0), (7, None, 0), (8, 1, 0), (9, 5, 0), (999, 1, 0)]
    rows = toxicity.report(*frames(spark, docs, labels)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) and by[100].p_toxic == by[101].p_toxic and by[None].held_out is False
    assert len({tuple(r) for r in rows if r.doc_id == 5}) == 2  # its own text, and two equal rows
    alone = toxicity.report(*frames(spark, [d for d in docs if d[0] != 102], labels)).collect()
    assert {r.doc_id: r.p_toxic for r in alone if r.doc_id == 6} == {6: by[6].p_toxic}  # an unlabelled row changes nothing


def test_no_labels_one_class_and_no_rows(spark):
    docs, labels = made(12)
    df, lab = frames(spark, docs, labels)
    assert not any(r.toxic for r in toxicity.report(df, lab.limit(0)).collect())
    assert not any(r.toxic for r in toxicity.report(df, lab.where("toxic = 0")).collect())
    assert all(r.toxic for r in toxicity.report(df, lab.where("toxic = 1")).collect())
    assert toxicity.report(df.limit(0), lab).count() == 0


def test_counts_and_standard_errors(spark):
    rows = spark.createDataFrame([(pack(np.array([1] + [2] * (i % 2))), i % 2) for i in range(200)], "features binary, y0 int")
    counts = toxicity.class_counts(rows.repartition(3), "y0")
    assert counts[:, [1, 2, toxicity.SIZE]].tolist() == [[100, 0, 100], [100, 100, 100]]
    z = toxicity.standard_errors(counts)
    assert z[2] > 5 and abs(z[1]) < 1e-9 and z[3] == 0


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100)
    rows = spark.createDataFrame([(i, bytes(40), 1) for i in range(20)], "doc_id long, features binary, y0 int")
    assert len(toxicity.sampled(rows, "y0", 1)) == 3 and toxicity.sampled(rows, "y0", 0) == []
    repeated = spark.createDataFrame([(7, bytes(40), 1)] * 50, "doc_id long, features binary, y0 int")
    assert len(toxicity.sampled(repeated, "y0", 1)) == 3
