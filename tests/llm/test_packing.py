import random

import pytest

from quillspark.llm import packing
from quillspark.llm.packing import TOKENIZER, counter, fill_report, pack, plan_containers


@pytest.mark.parametrize("seed", range(12))
def test_a_plan_places_every_item_once_and_ends(seed):
    r = random.Random(seed)
    capacity = r.choice([12, 100, 2048])
    counts = {}
    for _ in range(r.randrange(1, 1500)):
        n = min(capacity, max(1, int(r.lognormvariate(5, 1))))
        counts[n] = counts.get(n, 0) + r.choice([1, 1, 40])
    plan = plan_containers(list(counts.items()), capacity)
    placed = {}
    for copies, pattern in plan:
        assert copies >= 1 and sum(s * k for s, k in pattern) <= capacity
        for s, k in pattern:
            placed[s] = placed.get(s, 0) + copies * k
    assert placed == counts
    used, total = sum(c for c, _ in plan), sum(s * k for s, k in counts.items())
    # First fit decreasing's bound.
    assert used <= -(-total // capacity) * 11 / 9 + 1 or used <= sum(counts.values())


def test_a_short_count_does_not_stop_the_plan():
    assert sum(c for c, _ in plan_containers([(5, 1), (4, 1), (2, 1)], 12)) == 1
    assert plan_containers([], 12) == []


def test_items_are_whole_unless_longer_than_a_container(spark):
    rows = [(i, n, "x") for i, n in enumerate([5, 5, 5, 7, 3, 10, 25, 30, 1, 1, None, 0])] + [(3, 7, "x")]
    out = pack(spark.createDataFrame(rows, "doc_id bigint, tokens bigint, container_id string"), 10).collect()
    per, mine = {}, {}
    for r in out:
        per[r.container_id] = per.get(r.container_id, 0) + r.piece_tokens
        mine.setdefault(r.doc_id, []).append(r.piece_tokens)
    assert max(per.values()) <= 10 and sorted(per) == list(range(len(per)))
    assert sorted(mine[6]) == [5, 10, 10] and sorted(mine[7]) == [10, 10, 10] and mine[3] == [7, 7]
    assert sum(map(sum, mine.values())) == sum(n for _, n, _ in rows if n)
    (f,) = fill_report(pack(spark.createDataFrame(rows[:-1], "doc_id bigint, tokens bigint, c string").drop("c"), 10), 10).collect()
    assert f.fewest == 10 and f.tokens == 92 and f.containers == 10


def test_an_empty_table_gives_no_rows(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, tokens bigint"), 10).count() == 0


def test_tokens_counted_by_words_are_those_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    monkeypatch.setattr(packing, "WORDS_KNOWN", 50)
    r = random.Random(2)
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 61 == 0)]
    texts = [f"a{''.join(c)} 1{c[0]}!{c[1]}{c[2]}  x{c[3]}\n " for c in zip(*[iter(signs)] * 4)]
    texts += ["".join(r.choice(" \n\t'sStrvelmd1é…  ") for _ in range(60)) for _ in range(2000)]
    texts += ["<|endoftext|> it's IT'S we'll 'tis  ", "", " ", "x" * 5000, "\x00\x1c\x1f\x85\u200b\u3000z"]
    assert counter(TOKENIZER)(texts) == [len(t.encode(x, add_special_tokens=False)) for x in texts]
