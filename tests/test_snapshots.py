import random

from casemill.operators import snapshots

INVENTORY = "snapshot_id string, case_id string, content_hash string, discovered_at string, seq int, scope_id string"
HEADERS = "snapshot_id string, scope_id string, timestamp string, total_cases int, source string"


def changes(spark, inventory, headers):
    inv = spark.createDataFrame([(*r, 7, "clash") for r in inventory], INVENTORY)
    head = spark.createDataFrame([(*r, 0, "x") for r in headers], HEADERS)
    return sorted(tuple(r) for r in snapshots.snapshot_changes(inv, head, 3).collect())


def brute(inventory, headers):
    clean = lambda x: (x or "").strip().lower() or None
    out = []
    present = {r[0] for r in inventory}
    for scope in {h[1] for h in headers}:
        order = [s for _, s in sorted({(h[2], h[0]) for h in headers if h[1] == scope and h[0] in present})]
        tables = []
        for s in order:
            best = {}
            for _, case, digest, at in (r for r in inventory if r[0] == s):
                k, v = clean(case), (at, clean(digest) or "")
                if k and v >= best.get(k, ("", "")):
                    best[k] = v
            tables.append({k: v[1] for k, v in best.items()})
        for s, a, b in zip(order[1:], tables, tables[1:], strict=False):
            out += [(s, k, "added") for k in b.keys() - a.keys()]
            out += [(s, k, "removed") for k in a.keys() - b.keys()]
            out += [(s, k, "changed") for k in a.keys() & b.keys() if a[k] != b[k]]
    return sorted(out)


def test_random_deliveries_against_brute_force(spark):
    rng = random.Random(3)
    headers = [(f"s{k}", f"scope{k % 2}", f"2025-01-{k + 1:02d}T00:00:00Z") for k in range(10)]
    headers += [headers[3], ("empty", "scope0", "2025-01-05T12:00:00Z")]
    rows = []
    for k in range(10):
        for case in range(12):
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                name = rng.choice([f"c{case}", f" C{case}\t"])
                digest = rng.choice(["aa", "AA ", "bb", None, " "])
                rows.append((f"s{k}", name, digest, f"2025-01-{k + 1:02d}T0{rng.randrange(3)}:00:00"))
    rows += [("orphan", "c1", "zz", "2025-01-01T00:00:00"), ("s1", None, "aa", "2025-01-01T00:00:00")]
    assert changes(spark, rows, headers) == brute(rows, headers)


def test_zones_order_deliveries(spark):
    headers = [("late", "x", "2025-01-01T20:00:00-05:00"), ("early", "x", "2025-01-02T00:30:00"), ("mid", "x", "2025-01-02T00:45:00.500Z")]
    rows = [("early", "a", "1", "t"), ("mid", "a", "2", "t"), ("late", "b", "1", "t")]
    assert changes(spark, rows, headers) == [("late", "a", "removed"), ("late", "b", "added"), ("mid", "a", "changed")]


def test_empty_tables(spark):
    assert changes(spark, [], [("s", "x", "2025-01-01")]) == []
    assert changes(spark, [("s", "a", "1", "t")], []) == []


def test_merge_runs_on_sorted_ranges(spark):
    inv = spark.createDataFrame([("s", "a", "1", "t", 1, "x")], INVENTORY)
    head = spark.createDataFrame([("s", "x", "2025-01-01", 0, "x")], HEADERS)
    plan = snapshots.snapshot_changes(inv, head)._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("lag(") :]
    assert "rangepartitioning" in window[: window.index("hashpartitioning")]
