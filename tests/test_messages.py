import random

from pyspark.sql import functions as F

from flashmill.operators import messages
from flashmill.operators.prefilter import maybe_in
from flashmill.session import Versions


def test_replayed_batches_keep_one_of_each(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, "hot", "hot", *[f"m{k}" for k in range(300)]]), i // 200, "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "seq long, _key string, batch long, kept string")
    store = messages.SeenStore(spark, f"file://{tmp_path}/seen", shards=4)
    dups, first = [], {}
    for b in range(5):
        dups.append(store.add(df.filter(F.col("batch") == b).withColumnRenamed("_key", "m"), F.col("m"), "seq"))
    want = set()
    for seq, m, _, _ in rows:
        if m is not None and first.setdefault(m, seq) != seq:
            want.add((first[m], seq))
    assert {(r.kept, r.dup) for d in dups for r in store.kept(d).collect()} == want


def test_one_bulk_batch_with_a_hot_message(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"m{i % 50}") for i in range(6000)], "seq long, m string")
    store = messages.SeenStore(spark, f"file://{tmp_path}/seen", shards=2)
    out = {(r.kept, r.dup) for r in store.kept(store.add(df, F.col("m"), "seq")).collect()}
    first = {}
    assert out == {(first[m], s) for s, m in ((i, "hot" if i % 3 == 0 else f"m{i % 50}") for i in range(6000)) if first.setdefault(m, s) != s}


def test_a_smaller_order_value_in_a_later_batch(spark, tmp_path):
    store = messages.SeenStore(spark, f"file://{tmp_path}/seen", shards=2)
    frame = lambda rows: spark.createDataFrame(rows, "seq long, m string")
    dups = [store.add(frame(x), F.col("m"), "seq") for x in ([(5, "a"), (6, "b"), (9, "a")], [(2, "a"), (3, "a"), (7, "b")], [(4, "a"), (8, "c")])]
    assert sorted((r.kept, r.dup) for d in dups for r in store.kept(d).collect()) == [(2, 3), (2, 4), (2, 5), (2, 9), (6, 7)]


def test_a_run_that_dies_at_any_step_can_be_repeated(spark, tmp_path, monkeypatch):
    class Dies(Exception):
        pass

    monkeypatch.setattr(messages.SeenStore, "MAX_PARTS", 1)
    frame = lambda rows: spark.createDataFrame(rows, "seq long, m string")
    one, two = frame([(1, "a"), (2, "b"), (3, "a")]), frame([(4, "b"), (5, "c"), (6, "c")])
    write, commit, step = messages.SeenStore._write, Versions.commit, 0
    while True:
        store = messages.SeenStore(spark, f"file://{tmp_path}/seen{step}", shards=2)
        first = store.add(one, F.col("m"), "seq", token="0")
        left = [step]

        def dying(f):
            def run(self, *a):
                left[0] -= 1
                if left[0] < 0:
                    raise Dies
                return f(self, *a)

            return run

        monkeypatch.setattr(messages.SeenStore, "_write", dying(write))
        monkeypatch.setattr(Versions, "commit", dying(commit))
        try:
            store.add(two, F.col("m"), "seq", token="1")
            died = False
        except Dies:
            died = True
        monkeypatch.setattr(messages.SeenStore, "_write", write)
        monkeypatch.setattr(Versions, "commit", commit)
        again = messages.SeenStore(spark, f"file://{tmp_path}/seen{step}", shards=2)
        second = again.add(two, F.col("m"), "seq", token="1")
        assert sorted((r.kept, r.dup) for d in (first, second) for r in again.kept(d).collect()) == [(1, 3), (2, 4), (5, 6)]
        if not died:
            break
        step += 2
    assert step > 4


def test_empty_batch(spark, tmp_path):
    df = spark.createDataFrame([], "seq long, m string")
    store = messages.SeenStore(spark, f"file://{tmp_path}/seen")
    assert store.add(df, F.col("m"), "seq").count() == 0
    assert store.add(df, F.col("m"), "seq").count() == 0


def test_prefilter_drops_no_key(spark):
    rows = spark.range(5000).selectExpr("cast(id as string) as k", "id")
    keys = spark.range(0, 5000, 50).selectExpr("cast(id as string) as k")
    got = {r.k for r in maybe_in(rows, "k", keys, "k", 100).collect()}
    assert {str(i) for i in range(0, 5000, 50)} <= got and len(got) < 1000
