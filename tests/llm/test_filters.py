"""Decontamination both ways, and mixing, on hard rows."""

from llm_fixtures import HARD, base, rows

from tickbars.llm import decontaminate, mixing

ITEMS = [(1, base(20, 5)), (2, "one"), (3, None), (4, base(13, 200)), (1, base(20, 5)), (5, "")]


def test_broadcast_and_shuffle_agree(spark, hard, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    direct = rows(decontaminate.report(hard, items))
    assert len(direct) == len(HARD)
    by_id = {r[0]: r for r in direct}
    assert by_id[1][1:4] == (40, 20, 1) and by_id[7][5] and by_id[8][1:4] == (3, 0, 0)  # its wide spaces are no ASCII
    assert by_id[10][2:4] == (13, 1) and not by_id[10][5]
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert rows(decontaminate.report(hard, items)) == direct


def test_mix_meets_targets(hard, empty):
    mixed = mixing.mix(hard, mixing.repeating_weights(hard)).collect()
    assert len(mixed) == len(HARD)
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in mixed)
    assert mixing.mix(empty, mixing.repeating_weights(empty)).count() == 0
