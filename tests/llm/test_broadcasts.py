"""Tables that Spark takes for smaller than they are must not go through the driver."""

from helpers import table, text

from citeloom.llm import minhash_dedup


def plans(monkeypatch, module, run):
    """The physical plan of each table that run stores, by name."""
    found, plain = {}, module.stored

    def stored(df, name):
        found[name] = df._jdf.queryExecution().sparkPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(module, "stored", stored)
    run().collect()
    return found


def test_opened_keys_are_not_broadcast(spark, monkeypatch):
    rows = [(i, text(i // 2, 60)) for i in range(40)]
    found = plans(monkeypatch, minhash_dedup, lambda: minhash_dedup.near_duplicates(table(spark, rows)))
    keys = found["bucket-members"]
    assert "Generate explode" in keys and "SortMergeJoin [key" in keys and "BroadcastHashJoin" not in keys
    assert "BroadcastHashJoin [shingle" not in found["prefixes"] and "SortMergeJoin [shingle" in found["prefixes"]
    for name in ("shared-prefixes", "other-pairs"):
        assert "SortMergeJoin [shingle" in found[name] and "BroadcastHashJoin [shingle" not in found[name]
