"""The training-data operators against brute force, SQL, round trips and held-out accuracy, and on nulls,
empty texts, repeated rows, ties and empty tables."""

import gzip
import hashlib
import io
import os
import re
import subprocess
import sys
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from shopflow.llm import (archives, decontaminate, jaccard_join, mixing, pseudo_lm, quality, secrets_crf, sharding,
                          url_rules, vector_search)
from shopflow.llm.queries import QUERIES, SQL
from shopflow.llm.store import fresh
from shopflow.plans.verify import compare_one, duck

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string"
ODD = [(1, None, "en", "a", 0, 7, "x"), (2, "", None, None, 0, 7, "x"), (3, " \n\t", "en", "a", 3, 7, "x"),
       (4, "one two", "en", "b", 7, 7, "x"), (4, "one two", "en", "b", 7, 7, "x"), (5, "One  two", "en", "b", 8, 7, "x"),
       (None, "a b c d e f g h", None, "a", 15, None, None), (6, "w " * 30000, "en", "a", 60000, 7, "x")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts(base=SMALL):
    d = pd.read_parquet(f"{base}/documents.parquet")
    return dict(zip(d.doc_id, d.text))


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def shingles(t):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_brute(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in sorted(sets.items()):
        for j, c in Counter(j for g in s for j in held[g]).items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
        for g in s:
            held[g].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark):
    base = texts()
    rng = np.random.default_rng(3)
    for k, n in enumerate([4, 5, 6, 9, 12, 20, 40, 150, 150, 150]):  # families of edited copies of all sizes
        origin = [f"w{k}x{j}" for j in range(n + 4)]
        for c in range(12):
            w = list(origin)
            for _ in range(c % 4):
                w[rng.integers(len(w))] = f"e{rng.integers(9)}"
            base[10_000 + 100 * k + c] = " ".join(w)
    df = spark.createDataFrame(list(base.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == near_brute(base)


def test_near_duplicates_odd_rows(odd, none):
    rows = sorted(jaccard_join.near_duplicates(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_shingles))
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in rows] == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (None, 4, None)]
    assert jaccard_join.near_duplicates(none).count() == 0


def test_near_duplicates_of_null_and_repeated_ids(spark):
    import corpus_pipeline as cp
    word = lambda k, *cut: " ".join(f"e{k}{j}" if j in cut else f"w{k}x{j}" for j in range(150))
    rows = [(1, word(1)), (None, word(1, 0)), (None, word(2)), (None, word(2, 149)), (3, word(3)), (3, word(4)),
            (5, word(3, 0)), (6, word(4, 149)), (7, word(5, 0, 50, 51)), (None, word(5)), (8, word(5, 100, 101, 149))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {(i, 146, c) for i, c in [(1, 1), (None, 1), (None, None), (3, 3), (5, 3), (6, 3), (7, 7), (None, 7), (8, 7)]}
    kept = {(r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, df, SMALL).collect()}
    assert {(1, word(1)), (3, word(3)), (3, word(4)), (7, word(5, 0, 50, 51))} <= kept and len(kept) == 5
    assert {t for i, t in kept if i is None} <= {word(2), word(2, 149)}


def test_pipeline_judges_rows_not_ids(spark):
    import corpus_pipeline as cp
    a, b, c, d, e = (" ".join(f"{k}{j}" for j in range(40)) for k in "abcde")
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (7, c, "x"), (7, d, "x"), (None, e, "x"), (None, e, "y"), (9, "", "x"),
            (9, "", "x"), (9, None, "x"), (2, c, "x"), (1, a, "z")]
    for parts, order in ((1, rows), (3, rows[::-1]), (7, rows[5:] + rows[:5])):
        df = spark.createDataFrame(order, "doc_id long, text string, why string").repartition(parts)
        kept = cp.drop_near_duplicates(spark, df, SMALL)
        assert kept.columns == df.columns
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
        assert got == sorted([(1, a), (5, b), (2, c), (7, d), (None, e), (9, ""), (9, ""), (9, None)], key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, name):
    ok, detail, *_ = compare_one(spark, duck(SMALL), name, QUERIES[name], SQL[name], SMALL)
    assert ok, detail


def test_url_rules_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.com/en/x?y#z", "http://xexample.com/en/", "http://a.net/es",
            "http://a.net/es/", "http://example.com", "x://com/", "http://a.b.example.com/en/q"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls + urls)], "page_id long, url string, verdict string")
    got = {(r.page_id, r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rule_table(spark), partitions=4).collect()}
    want = {0: None, 1: None, 2: None, 3: None, 4: "www.example.com/en/", 5: "com/", 6: None, 7: "net/es/", 8: None, 9: "com/",
            10: "example.com/en/"}
    kind = {v: k for k, v in url_rules.FIXED_RULES}
    assert got == {(i + d, r, kind.get(r, "allow")) for i, r in want.items() for d in (0, len(urls))}
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark)).count() == 0


def test_vector_search_finds_true_neighbours(spark):
    d = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    x = np.stack(d.embedding).astype(float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    got = defaultdict(list)
    for r in sorted(QUERIES["op3_vector_search"](spark, SMALL).collect()):
        got[r.query_id].append((r.vec_id, r.score))
    hit = n = 0
    for q in np.flatnonzero(d.vec_id % 50 == 0):
        s = u @ u[q]
        s[q] = -2
        best = d.vec_id.to_numpy()[np.lexsort((d.vec_id, -s.round(12)))[:5]]
        n, hit = n + 5, hit + len(set(best) & {v for v, _ in got[d.vec_id[q]]})
    assert hit >= 0.9 * n
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (50, [1.0, 0.0]),
            (None, [1.0, 1.0]), (7, [1.0, None]), (8, [0.0, 1.0])]
    odd = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [tuple(r) for r in sorted(vector_search.search(odd).collect())]
    assert out == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 1.0), (0, 4, 8, 0.0),
                   (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 1.0), (50, 4, 8, 0.0)]
    assert vector_search.search(odd.limit(0)).count() == 0


def test_hilbert_keys_visit_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = vector_search.hilbert_keys(cells, 2)
    assert sorted(keys) == list(range(64))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_quality_held_out_accuracy(spark, odd, none):
    base = "/root/testdata/sf0.1"
    labels = pd.read_parquet(f"{base}/labels.parquet").set_index("doc_id").quality
    got = QUERIES["op5_quality_classifier"](spark, base).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    test = got[got.held_out & got.doc_id.isin(labels.index)]
    y = test.doc_id.map(labels)
    assert (test.predicted == y).mean() > 0.97 and test.predicted[y == 1].mean() > 0.99
    few = spark.createDataFrame([(3, 1, 0), (4, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = quality.classify(odd, few).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in quality.classify(odd, few.limit(0)).collect()} == {0.5}
    assert quality.classify(none, few).count() == 0
    assert quality.scored(odd, few).columns == [*odd.columns, "score", "predicted"]


def test_mixing_meets_targets(spark, odd, none):
    docs = texts(MIDDLE)
    d = pd.read_parquet(f"{MIDDLE}/documents.parquet")
    got = QUERIES["op6_source_mixing"](spark, MIDDLE).toPandas()
    assert (got["size"] == got.doc_id.map(lambda i: len(WORD.findall(docs[i] or "")))).all()
    assert (got.taken <= 3 * got["size"]).all() and len(got) == len(d)
    per = got.groupby("source").agg(size=("size", "sum"), target=("target", "max"), taken=("taken", "sum"), top=("size", "max"))
    assert abs(per.target.sum() - per["size"].sum()) < 1e-3
    assert ((per.taken - per.target).abs() <= per.top / 2 + 1).all()
    again = QUERIES["op6_source_mixing"](spark, MIDDLE).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0
    assert mixing.mixed(odd).columns == odd.columns and mixing.mixed(none).count() == 0


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 10), (None, 1)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"b": 30.0, "c": 30.0, None: 3.0, "a": 58.0}


def test_sharding_is_the_exact_minimax(spark, odd, none):
    docs = texts(MIDDLE)
    got = QUERIES["op10_sharding"](spark, MIDDLE).toPandas()
    size = {i: len((t or "").encode()) + 1 for i, t in docs.items()}
    assert got["size"].tolist() == [size[i] for i in got.doc_id] and len(got) == len(docs)
    assert got.text_crc32.tolist() == [zlib.crc32((docs[i] or "").encode()) for i in got.doc_id]
    for _, s in got.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    assert (got.assign(t=got.doc_id.map(docs).fillna("")).groupby("t").shard.nunique() == 1).all()
    base = spark.read.parquet(f"{MIDDLE}/documents.parquet").select(
        sharding.text_bytes(sharding.F.col("text")).alias("size"), sharding.text_hash(sharding.F.col("text")).alias("g"))
    groups = [r["b"] for r in base.groupBy("g").agg(sharding.F.sum("size").alias("b")).orderBy("g").collect()]
    sums = list(accumulate(groups))

    def fits(cap):
        at = 0
        for _ in range(16):
            at = bisect_right(sums, (sums[at - 1] if at else 0) + cap)
        return at == len(sums)

    plan = sharding.plan(base)
    assert not plan.giants and fits(plan.capacity) and not fits(plan.capacity - 1)
    assert got.groupby("shard")["size"].sum().max() <= plan.capacity
    hot = spark.createDataFrame([(i, "x" * 900 if i < 40 else f"t{i}" * 9) for i in range(120)], "doc_id long, text string")
    by = sharding.shard(hot).groupBy("shard").agg(sharding.F.sum("size").alias("b")).toPandas().b.tolist()
    assert max(by) == 40 * 901 and len(by) == 16
    assert sharding.shard(odd).count() == len(ODD) and sharding.shard(none).count() == 0
    assert sharding.sharded(odd).columns == [c for c in odd.columns if c not in ("size", "shard")] + ["size", "text_crc32", "law", "shard"]


def test_leaks_of_edited_copies(spark, odd, none):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rng = np.random.default_rng(1)
    rows, want = [], set()
    for k, (i, t) in enumerate(sorted(items.items())):
        w = t.split()
        for j in range(5, len(w), 6):
            w[j] = "changed"
        if k % 3 == 1:
            del w[len(w) // 2]
        filler = [" ".join(f"f{rng.integers(500)}" for _ in range(60)) for _ in range(2)]
        rows.append((k, f"{filler[0]} {' '.join(w).upper() if k % 2 else ' '.join(w)} {filler[1]}"))
        want.add((k, i))
        rows.append((1000 + k, " ".join(filler)))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert want <= got and {d for d, _ in got} <= {d for d, _ in want}
    blocks = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, block_bytes=2000)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == got
    odd_bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "c d e f")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, odd_bench).collect()}
    assert found == {(4, 3), (5, 3), (None, None)}
    assert decontaminate.leaks(none, bench).count() == 0 and decontaminate.leaks(odd, odd_bench.limit(0)).count() == 0


@pytest.mark.parametrize("step", [4, 5])
def test_leaks_of_one_edited_form_in_many_documents(spark, step):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = sorted((r.item_id, r.text) for r in bench.collect())[:4]
    rng, rows, want = np.random.default_rng(4), [], set()
    for (i, t), (copies, whole) in zip(items, [(3, 0), (100, 0), (3, 2), (100, 2)]):
        edited = " ".join("changed" if (j + 1) % step == 0 else w for j, w in enumerate(t.split()))
        for part in [edited] * copies + [t] * whole:
            host = [" ".join(f"f{rng.integers(500)}" for _ in range(60)) for _ in range(2)]
            want.add((len(rows), i))
            rows.append((len(rows), f"{host[0]} {part} {host[1]}"))
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert want <= {(r.doc_id, r.item_id) for r in got}


def test_pseudo_likelihood(spark, odd, none):
    top, rows = pseudo_lm.fit(spark.read.parquet(f"{MIDDLE}/documents.parquet"), rounds=1, step=8)
    model = pseudo_lm.Model.of(rows)
    ctx = np.repeat([[70, 80, pseudo_lm.PAD, 100]], pseudo_lm.VOCAB, axis=0)
    assert abs(np.exp(model.log_prob(ctx, np.arange(pseudo_lm.VOCAB))).sum() - 1) < 1e-4
    start = pseudo_lm.Model()
    t = np.random.default_rng(0).integers(64, 80, 4000)
    ctx = pseudo_lm.contexts(t, np.zeros(len(t), dtype=np.int64))
    state = [np.full_like(w, 1e-4) for w in (start.emb, start.cls, start.out)]
    before = start.log_prob(ctx, t).mean()
    for a in range(0, 4000, 500):
        start.train(ctx[a:a + 500], t[a:a + 500], state)
    assert start.log_prob(ctx, t).mean() > before + 2
    got = {r.doc_id: r for r in pseudo_lm.score(odd).collect()}
    assert got[1].n_tokens == 0 and got[1].log_prob == 0.0 and got[1].mean_log_prob is None and got[6].n_tokens == 30000
    assert pseudo_lm.score(none).count() == 0


def test_language_model_trains_on_every_position(monkeypatch):
    seen = []
    monkeypatch.setattr(pseudo_lm.Model, "train", lambda self, ctx, target, state: seen.extend(target.tolist()))
    docs = [" ".join(f"v{i}x{j}" for j in range(n)) for i, n in enumerate([1, 3, 7, 31, 32, 33, 64, 100])]
    names = [w for t in docs for w in t.split()]
    b = [w.encode() for w in names]
    cuts = np.cumsum([0, *map(len, b)])
    top = pseudo_lm.hash_spans(np.frombuffer(b"".join(b), dtype=np.uint8), cuts[:-1], cuts[1:])
    value = lambda v: type("Value", (), {"value": v})()
    for turn in range(pseudo_lm.ROUNDS):
        batch = pa.record_batch([pa.array(docs)], names=["text"])
        list(pseudo_lm._train(value(top), value(pseudo_lm.Model().rows()), pseudo_lm.STEP, turn)(iter([batch])))
    assert sorted(seen) == [pseudo_lm.RARE + k for k in range(len(names))]


def test_collected_frees_the_last_shuffle_on_a_cluster(tmp_path):
    """Executors of their own, as on a cluster: there one collection leaves the last plan's shuffle files."""
    script = f"""
import glob, time
from pyspark.sql import SparkSession, functions as F
from shopflow.llm.store import collected, written
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config(map={{
    "spark.ui.enabled": "false", "spark.executor.memory": "600m", "spark.driver.host": "127.0.0.1",
    "spark.checkpoint.dir": "{tmp_path}/kept", "spark.local.dir": "{tmp_path}/local", "spark.sql.shuffle.partitions": "4"}}).getOrCreate()
left = lambda: glob.glob("{tmp_path}/local/**/shuffle_*.data", recursive=True)
out = written(spark.range(100000).repartition("id").groupBy("id").agg(F.count("*").alias("c"))
              .withColumn("m", F.expr("max(c) over (partition by id)")), "x")
assert left()
collected(spark)
until = time.time() + 5
while left() and time.time() < until:
    time.sleep(0.2)
assert not left() and out.count() == 100000
spark.stop()
print("freed")
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13",
                        "SPARK_LOCAL_DIRS": f"{tmp_path}/local"}
    got = subprocess.run([sys.executable, "-c", script], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert got.stdout.strip().endswith("freed"), got.stderr[-1500:]


def _plain_step(rows, ctx, target, state):
    """An AdaGrad step of the language model, position by position, in doubles."""
    m = pseudo_lm.Model.of(rows.astype(np.float64))
    out = pseudo_lm.Model.of(rows.astype(np.float64))
    grads = [np.zeros_like(w) for w in (m.emb, m.cls, m.out)]
    for c, t in zip(ctx, target):
        at = c + np.arange(4) * (pseudo_lm.VOCAB + 1)
        h = np.append(np.tanh(m.emb[at, :-1].sum(axis=0)), 1)
        k, one = t // pseudo_lm.PER_CLASS, slice(t // pseudo_lm.PER_CLASS * pseudo_lm.PER_CLASS, (t // pseudo_lm.PER_CLASS + 1) * pseudo_lm.PER_CLASS)
        g, u = np.exp(m.cls @ h), np.exp(m.out[one] @ h)
        g, u = g / g.sum(), u / u.sum()
        g[k] -= 1
        u[t % pseudo_lm.PER_CLASS] -= 1
        dh = (g @ m.cls + u @ m.out[one])[:-1] * (1 - h[:-1] ** 2)
        grads[0][at, :-1] += dh
        grads[1] += np.outer(g, h)
        grads[2][one] += np.outer(u, h)
    for w, s, g in zip((out.emb, out.cls, out.out), state, grads):
        s += (g / len(target)) ** 2
        w -= pseudo_lm.RATE * g / len(target) / np.sqrt(s)
        np.clip(w, -pseudo_lm.LIMIT, pseudo_lm.LIMIT, out=w)
    return out.rows()


def test_language_model_step_serves_all_classes_at_once(monkeypatch):
    calls = []
    plain = pseudo_lm.Model._step
    monkeypatch.setattr(pseudo_lm.Model, "_step", staticmethod(lambda *a: (calls.append(1), plain(*a))))
    rng = np.random.default_rng(3)
    model = pseudo_lm.Model()
    state = [np.full_like(w, 1e-4) for w in (model.emb, model.cls, model.out)]
    for target in (rng.integers(0, pseudo_lm.VOCAB, 300), rng.integers(0, 60, 100), np.full(40, pseudo_lm.VOCAB - 1), np.array([7])):
        ctx = rng.choice([0, 1, 2, 70, pseudo_lm.PAD], (len(target), 4))
        want_state = [s.astype(np.float64) for s in state]
        want = _plain_step(model.rows(), ctx, target, want_state)
        calls.clear()
        model.train(ctx, target, state)
        assert len(calls) == 3  # the three tables, however many classes the batch holds
        assert np.allclose(model.rows(), want, atol=2e-5)
        assert all(np.allclose(s, w, atol=1e-6) for s, w in zip(state, want_state))
        p = pseudo_lm.Model.of(want).log_prob(ctx, target)
        assert np.allclose(model.log_prob(ctx, target), p, atol=1e-3)


def test_word_tokens_by_hash_head():
    words_ = [f"w{k}" for k in range(3000)] + ["é" * 5, "x" * 40]
    b = [w.encode() for w in words_]
    data = np.frombuffer(b" ".join(b), dtype=np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in b[:-1]])
    ends = starts + np.array([len(w) for w in b])
    top = pseudo_lm.hash_spans(data, starts, ends)[:2240][::-1].copy()
    got = pseudo_lm.Vocabulary(top).tokens(data, starts, ends)
    assert got[:2240].tolist() == [pseudo_lm.RARE + 2239 - k for k in range(2240)]
    assert got[2240:3000].tolist() == [4] * 760 and got[3000:].tolist() == [32 + 9, 31]
    assert (pseudo_lm.Vocabulary(top[:0]).tokens(data, starts, ends) < pseudo_lm.RARE).all()


def test_word_counts_are_whole(monkeypatch):
    monkeypatch.setattr(pseudo_lm, "KEEP", 50)
    texts_ = [" ".join(f"v{(7 * i + j) % 400}" for j in range(60)) for i in range(40)]
    got = Counter()
    for b in pseudo_lm._word_counts(pa.record_batch([pa.array([t])], names=["text"]) for t in texts_):
        for w, n in zip(*(c.to_pylist() for c in b.columns)):
            got[w] += n
    assert sorted(got.values()) == sorted(Counter(w for t in texts_ for w in t.split()).values())


def test_damaged_archives_are_rejects_not_the_end(spark, tmp_path):
    """Blanks in urls, broken header lines, cut records and broken gzip streams: the rest is read."""
    def rec(v, url, body):
        return archives.arc_record(v, url, "2001", "text/html", body, 0, "f") + b"\n"

    folder = tmp_path / "arcs"
    folder.mkdir()
    for v in (1, 2):
        start = archives.arc_start(v, "f", archives.ARC_DATE) + b"\n"
        good = [rec(v, f"http://a/{k}", b"HTTP/1.1 200 OK\r\nContent-Length: x\r\n\r\nbody %d" % k) for k in range(3)]
        bad = good[1].replace(b" text/html ", b" text/html x", 1) if v == 1 else b"http://a/1 broken\n\xff\xfe text\n"
        (folder / f"v{v}.arc").write_bytes(start + good[0] + rec(v, "http://b/ c d", b"") + bad + good[2])
        (folder / f"cut{v}.arc").write_bytes(start + good[0] + good[1][:-5])
    whole = gzip.compress(archives.arc_start(1, "f", "2001") + b"\n" + rec(1, "http://z/", b"y") + bytes(range(256)) * 400)
    (folder / "zip.arc.gz").write_bytes(whole[:-300])
    (folder / "none.arc").write_bytes(b"no archive at all\n" * 3)
    (folder / "empty.arc").write_bytes(b"")
    urls = sorted(r.url for r in archives.read_arc(spark, f"file:{folder}").collect())
    assert urls == sorted(["http://a/0", "http://a/2", "http://b/%20c%20d"] * 2 + ["http://a/0"] * 2 + ["http://z/"])
    rejects = [(r.path.rsplit("/", 1)[1], r.reason) for r in archives.arc_rejects(spark, f"file:{folder}").collect()]
    assert sorted(f for f, _ in rejects if f != "zip.arc.gz") == ["cut1.arc", "cut2.arc", "none.arc", "v1.arc", "v2.arc"]
    assert any(f == "zip.arc.gz" for f, _ in rejects)
    out = f"{fresh(spark, 'warc')}"
    archives.write_warc(spark, f"file:{folder}", out)
    assert archives.read_warc(spark, out).count() == len(urls)


def test_url_marks_inside_labels_match_no_foreign_rule(spark):
    hosts = ["com", "com\x01evil", "a.com", "a\x01.com", "com\x02", "com\x02\x02evil", "x.com\x01evil", "com\x00evil", "\x01com"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    rules = spark.createDataFrame([("block", "com", "/"), ("block", "com\x02\x02evil", "/x")], "verdict string, host string, path string")
    got = {r.host: r.rule for r in url_rules.judge(pages, rules, partitions=3).collect()}
    assert got == {h: next((rh + rp for rh, rp in (("com\x02\x02evil", "/x"), ("com", "/")) if h == rh or h.endswith("." + rh)), None)
                   for h in hosts}


def test_archive_formats(spark):
    for version in (1, 2):
        raw = archives.arc_start(version, "f", archives.ARC_DATE) + b"\n" + archives.arc_record(
            version, "http://a/", "2001", "text/html", b"x\n\ny\r\n", 0, "f") + b"\n"
        assert list(archives.arc_records(io.BytesIO(raw))) == [archives.Record("http://a/", "2001", "text/html", b"x\n\ny\r\n")]
        with pytest.raises(ValueError):
            list(archives.arc_records(io.BytesIO(raw[:-5])))
    assert archives.warc_time("2001") == "2001-01-01T00:00:00Z"
    big = "é\r\n\r\nWARC/1.0\r\n" * 100
    rows = [(1, None, big), (2, "http://a b/", big), (2, "http://a b/", big), (3, "u", None), (4, "u", ""), (None, "u", big), (5, "u", "s"), (6, "u", "s")]
    got = sorted(map(tuple, archives.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    n, h = len(big.encode()), hashlib.sha1(big.encode()).hexdigest()
    e, s = hashlib.sha1(b"").hexdigest(), hashlib.sha1(b"s").hexdigest()
    assert got == sorted([(1, n, h, "revisit", 2), (2, n, h, "response", None), (2, n, h, "response", None), (3, 0, e, "response", None),
                          (4, 0, e, "response", None), (None, n, h, "revisit", 2), (5, 1, s, "response", None),
                          (6, 1, s, "response", None)], key=str)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.round_trip(empty).count() == 0


def test_secret_scan_equals_patterns(spark, odd, none):
    docs = texts(MIDDLE)
    docs |= {90001: 'Token="abcdefghijkl" AKIA' + "Q" * 14 + " é deadbeefdeadbeef", 90002: "token: password : abcdefghijkl123", 90003: None}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for r in secrets_crf.scan(df).collect():
        t, spans = docs[r.doc_id] or "", []
        for k, (p, n, g) in enumerate(((secrets_crf.ASSIGN, 12, 2), (secrets_crf.ACCESS, 18, 0), (secrets_crf.HEX, 16, 0))):
            spans += [(m.start(), k, m.end()) for m in p.finditer(t) if len(m.group(g)) >= n]
        base = [f"{secrets_crf.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert [s for s in r.spans.split(",") if s and not s.startswith("crf:")] == base
    assert secrets_crf.scan(odd).count() == len(ODD) and secrets_crf.scan(none).count() == 0


def test_crf_marginals_and_generalisation():
    rng = np.random.default_rng(2)
    e, t = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    p, pair = secrets_crf.marginals(e, t)
    paths = [x for x in np.ndindex(3, 3, 3, 3) if x[0] != secrets_crf.I]
    w = np.exp([sum(e[i, y] for i, y in enumerate(x)) + sum(t[a, b] for a, b in zip(x, x[1:])) for x in paths])
    want = np.array([[sum(v for v, x in zip(w, paths) if x[i] == k) for k in range(3)] for i in range(4)]) / w.sum()
    assert np.allclose(p, want) and abs(pair.sum() - 3) < 1e-9
    assert tuple(secrets_crf.viterbi(e, t)) == paths[int(np.argmax(w))]
    texts_ = [f'the token = "{hashlib.sha1(str(i).encode()).hexdigest()}" of w{i} see page-{i}-of-2024-08-11 now' for i in range(60)]
    model = secrets_crf.train(texts_)
    text = 'use bearer "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B" here, see page-77-of-2024-08-12 now'
    assert secrets_crf.crf_spans(text, *model) == [(12, 52)]


def test_pipeline_keeps_clean_documents(spark, odd):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = texts()
    out = cp.run(spark, SMALL).toPandas()
    assert set(out.doc_id) <= set(docs) and len(out) and set(out.columns) >= {"doc_id", "text", "lang", "source", "n_chars", "shard"}
    near = near_brute({i: docs[i] for i in set(out.doc_id)})
    assert len({c for _, c in near.values()}) == len(near)  # no two kept documents are linked
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, odd, SMALL).collect()} == {1, 2, 3, 4, 6, None}
    assert cp.drop_near_duplicates(spark, odd, SMALL).columns == odd.columns
    assert cp.drop_contaminated(spark, odd, SMALL).count() == len(ODD)
