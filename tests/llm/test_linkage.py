import random

from quillspark.llm.linkage import SortedRuns, repeats_on_arrival

_SCHEMA = "cand_id bigint, batch_id int, doi string, source string, source_id string"


def _found(spark, letters, batches):
    rows = [(i + 1, b, f"10.92317/{x}.2019.123456001", "s2", None) for i, (x, b) in enumerate(zip(letters, batches))]
    return {tuple(r) for r in repeats_on_arrival(spark.createDataFrame(rows, _SCHEMA)).collect()}


def test_spellings_apart_in_sort_order_are_linked_within_a_batch(spark):
    # The first two are a distance of 1 apart; those after them sort between them.
    letters = ["wfnw", "wnw", "wfw", "wfwn", "wnfw"]
    # On arrival, row 2 has only row 1 to repeat.
    want = {(1, i) for i in range(2, 6)}
    assert _found(spark, letters, [1] * 5) == want
    assert _found(spark, letters, range(1, 6)) == want


def test_a_later_session_goes_on_with_the_state(spark):
    first = [(1, 1, "10.92317/wfnw.2019.123456001", "s2", "a"), (2, 1, None, "s2", "b")]
    then = [(3, 2, "10.92317/wfnw.2019.123456001", "s2", "b"), (4, 2, None, "s2", "b"), (5, 2, None, "s2", None), (6, 2, None, "S2 ", " a ")]
    state = SortedRuns(spark)
    assert state.ingest(spark.createDataFrame(first, _SCHEMA)).count() == 0
    again = SortedRuns(spark, state.dir)
    assert {tuple(r) for r in again.ingest(spark.createDataFrame(then, _SCHEMA)).collect()} == {(1, 3), (1, 4), (1, 6)}
    again.compact()
    roots = {r.block: r.root for r in SortedRuns(spark, state.dir).runs().collect()}
    assert roots["s:s2:b"] == 1 and len(SortedRuns(spark, state.dir).state["runs"]) == 1


def test_many_small_batches_equal_brute_force(spark):
    r = random.Random(11)
    rows = [(i, 1 + i // 9, r.choice([None, f"10.92317/wfnw.2019.{r.randrange(12):09d}"]), "s2", r.choice([None, "-", f"id{r.randrange(14)}"])) for i in range(1, 100)]
    want, parts = set(), {}
    for i, _, doi, _, sid in rows:
        keys = [k for k in (doi, sid) if k and k != "-"]
        merged = {i}.union(*[parts.get(k, {k}) for k in keys], keys)
        for x in merged:
            parts[x] = merged
        if keys and (low := min(x for x in merged if isinstance(x, int))) < i:
            want.add((low, i))
    assert {tuple(x) for x in repeats_on_arrival(spark.createDataFrame(rows, _SCHEMA)).collect()} == want


def test_empty_and_null_rows(spark):
    assert repeats_on_arrival(spark.createDataFrame([], _SCHEMA)).count() == 0
    rows = [(None, 1, "10.1234/x.2019.123456", "s2", "a"), (1, None, None, None, None), (2, 1, "", "", "")]
    assert repeats_on_arrival(spark.createDataFrame(rows, _SCHEMA)).count() == 0


def test_a_delivery_shuffles_each_identity_a_few_times(spark):
    r = random.Random(3)
    rows = [(i, 1, f"10.92317/{''.join(r.choices('abcdefgh', k=5))}.2019.{r.randrange(10**12):012d}", "s2", f"{r.randrange(16**12):012x}|{r.randrange(16**12):012x}") for i in range(6000)]
    df = spark.createDataFrame(rows, _SCHEMA)
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before, state = written(), SortedRuns(spark)
    assert state.ingest(df).count() == 0
    assert (written() - before) / len(rows) < 425
    # A block may have the sign that ends it in a node's name.
    assert {(x.block, x.root) for x in state.runs().collect() if x.block.startswith("s:")} == {(f"s:s2:{x[4]}", x[0]) for x in rows}
