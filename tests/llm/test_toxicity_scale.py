"""The toxicity model learns from every labelled row, whatever their number."""

from pyspark.sql import functions as F

from trafficlens.llm import toxicity as T
from trafficlens.llm.labelled import held_out, training_rows


def corpus(spark, n=1500):
    """Every fifth document is toxic: those of even ids by one word, the others
    by another; ids that have two labels, two texts, or none."""
    word = "case when id % 5 <> 0 then 'plain' when id % 2 = 0 then 'vile' else 'nasty' end"
    docs = spark.range(n).selectExpr("id as doc_id", f"concat('the word ', {word}, ' stands among w', id % 50, ' others w', id % 7) as text")
    labels = spark.range(n).selectExpr("id as doc_id", "cast(id % 5 = 0 as int) as toxic")
    return docs, labels


def test_all_rows_are_trained_on(spark):
    docs, labels = corpus(spark)
    twice = docs.where("doc_id = 3").selectExpr("doc_id", "'a first text' as text")
    more = spark.createDataFrame([(2, 1), (None, 1), (7, None)], "doc_id bigint, toxic int")
    rows = training_rows(docs.unionByName(twice), labels.unionByName(more), "toxic", shard_rows=100)
    got = rows.withColumn("part", F.spark_partition_id()).collect()
    want = {r.doc_id for r in docs.where(~held_out()).collect()}
    assert sorted(r.doc_id for r in got) == sorted(want)
    by = {r.doc_id: r for r in got}
    assert all(by[i].label == (i % 5 == 0 or i == 2) for i in want)
    assert 3 not in want or by[3].text == "a first text"
    parts = {(r.shard, r.part) for r in got}
    assert len(parts) == len({s for s, _ in parts}) == -(-len(want) // 100)  # each whole in one partition
    features = T._features(rows)
    df, classes = T._frequencies(features)
    _, _, ids = T.tokens(T.pa.array(["word"], T.pa.large_string()))
    assert classes == {0, 1} and df[ids[0, 0]] == len(want) - (3 in want)  # every row is counted


def test_many_shards_learn(spark):
    docs, labels = corpus(spark)
    for shard_rows in (100, 5000):
        model = T.toxicity_model(docs, labels, shard_rows)
        got = T.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
        assert all(r.predicted == r.toxic for r in got)


def test_changes_are_averaged():
    net, other = T._Network(4, 1), T._Network(4, 1)
    state = net.state()
    net.embed[1] += 1
    net.squares["embed"][1] += 2
    net.const[0] += 3
    one = net.change(state, 10)
    net.load(state)
    net.embed[1:3] += 2
    net.squares["embed"][1:3] += 4
    two = net.change(state, 30)
    other.apply(T._merged(T._merged(None, one), two))
    assert abs(other.embed - state[0] - [[0], [1.5], [2], [0]]).max() < 1e-5
    assert abs(other.squares["embed"][:, 0] - state[2]["embed"][:, 0] - [0, 3, 4, 0]).max() < 1e-5
    assert abs(other.const[0] - 0.75) < 1e-6


def test_thresholds_count_rows():
    kept = T.np.array([(0, 0, -1.0, 90), (0, 1, 0.5, 1), (0, 0, 0.5, 2), (0, 1, 2.0, 9)])
    assert T._threshold(kept, 0.5) == -0.25 and T._threshold(kept, 0.05) == 1.25


def test_a_task_sums_the_changes_of_its_shards(spark):
    """Four shards or so a partition: what is shuffled to sum the changes grows
    with the partitions, not with the shards."""
    docs, labels = corpus(spark)
    rows = training_rows(docs, labels, "toxic", shard_rows=100)
    shards = rows.select("shard").distinct().count()
    assert rows.rdd.getNumPartitions() == -(-shards // 4) < shards
    per = rows.groupBy("shard", F.spark_partition_id().alias("part")).count().groupBy("shard").count()
    assert per.where("count > 1").count() == 0


def test_freed_memory_goes_back():
    import os

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGESIZE") / 1e6
    base = resident()
    held = [bytes(3000) for _ in range(60000)]  # small pieces come from the heap
    top = resident()
    keep = held[::1000]
    del held
    T.tb.release()
    assert top - base > 100 and resident() - base < 0.3 * (top - base) and len(keep) == 60
