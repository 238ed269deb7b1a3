from __future__ import annotations

import collections
import random
import re

from tests.llm.shapes import docs, rows_of
from tillscope.llm import decontam


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(words):
    if len(words) < 5:
        return collections.Counter([tuple(words)] if words else [])
    return collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows, items, least=0.8):
    found = set()
    for doc_id, text, _ in rows:
        words = words_of(text)
        for item_id, item in items:
            own = words_of(item)
            if not own or not words:
                continue
            a = shingles(own)
            for s in range(max(1, len(words) - len(own) + 1)):
                b = shingles(words[s : s + len(own)])
                if len(own) < 5 and len(words) - s < len(own):
                    continue
                both, every = sum((a & b).values()), sum((a | b).values())
                if both / every >= least:
                    found.add((doc_id, item_id))
    return found


def sample():
    rng = random.Random(6)
    vocab = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(rng.choice([3, 5, 6, 12, 30, 50])))) for k in range(30)]
    items += [(100, None), (101, ""), (102, items[3][1]), (103, "la " * 20)]
    rows = []
    for k in range(120):
        body = text(rng.choice([0, 2, 10, 120]))
        if k % 3 == 0:
            part = rng.choice(items[:30])[1].split()
            change = k % 9
            if change == 3 and len(part) > 20:
                part[rng.randrange(2)] = "other"
            if change == 6 and len(part) > 20:
                part = part[: len(part) // 2]
            at = rng.randrange(len(body) + 1)
            body[at:at] = part
        rows.append((k, "  \n".join(body) if k % 2 else " ".join(body).upper(), "s"))
    rows += [(500, None, None), (501, "", "s"), (502, "la " * 500, "s"), (None, items[4][1], "s"), (None, "clean text here", "s")]
    return rows, items


def test_windows_match_brute_force(spark):
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated_windows(docs(spark, rows, extra="item_id"), bench)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    same = {102: 3}  # equal items count as the smaller id
    assert got == {(d, same.get(i, i)) for d, i in brute(rows, items)}
    assert (502, 103) in got and (None, 4) in got


def test_without_a_broadcast(spark):
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, rows)
    small = decontam.contaminated_windows(df, bench, broadcast_shingles=0)
    assert rows_of(small, "doc_id", "item_id", "start") == rows_of(
        decontam.contaminated_windows(df, bench), "doc_id", "item_id", "start"
    )


def test_every_near_window_is_within_the_radius(spark):
    """Fingerprints of windows at the similarity bound differ in fewer bits than are looked at."""
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    wide = decontam.contaminated_windows(docs(spark, rows), bench, radius=63)
    assert wide.count() == decontam.contaminated_windows(docs(spark, rows), bench).count()


def test_filter_and_empty_tables(spark):
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, rows, extra="contaminated_id")
    kept = decontam.without_contaminated(df, bench)
    assert kept.columns == df.columns
    bad = {d for d, _ in brute(rows, items)}
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in rows} - bad
    assert decontam.contaminated_windows(df.limit(0), bench).count() == 0
    assert decontam.without_contaminated(df, bench.limit(0)).count() == len(rows)


def test_native_plan(spark):
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = decontam.contaminated_windows(docs(spark, rows), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_moved_blocks_match_brute_force(spark):
    """Items whose parts are swapped or shifted in the document."""
    rng = random.Random(8)
    items, rows = [], []
    text = lambda name, n: [f"{name}x{k}" for k in range(n)]
    for k in range(24):
        own = text(f"i{k}", rng.choice([20, 40, 60, 61]))
        items.append((k, " ".join(own)))
        cut = rng.choice([len(own) // 2, len(own) // 3, 2])
        moved = own[cut:] + own[:cut]
        if k % 4 == 0:
            moved[cut:cut] = ["between"] * rng.randrange(3)
        rows.append((k, " ".join(text(f"a{k}", rng.choice([0, 70])) + moved + text(f"b{k}", rng.choice([0, 70]))), "s"))
    halves = text("s", 30), text("t", 30)
    items.append((50, " ".join(halves[0] + halves[1])))
    rows.append((50, " ".join(text("f", 80) + halves[1] + halves[0] + text("g", 80)), "s"))
    expected = brute(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated_windows(docs(spark, rows), bench).collect()
    assert (50, 50) in expected and {(r.doc_id, r.item_id) for r in found} == expected
    best = next(r for r in found if r.doc_id == 50)
    assert (best.start, round(best.similarity, 3)) == (80, 0.867)


def test_long_texts_end_and_match_brute_force(spark):
    """One text of 20,000 words, one that repeats an item through, and many items of one length."""
    rng = random.Random(3)
    items = [(k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(40))) for k in range(1000)]
    filler = [f"f{rng.randrange(3000)}" for _ in range(20_000)]
    filler[11_000:11_000] = items[17][1].split()
    filler[:0] = items[18][1].split()[:38]
    rows = [(1, " ".join(filler), "s"), (2, " ".join([items[5][1]] * 300), "s"), (3, items[9][1], "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated_windows(docs(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id): r.start for r in found} == {(1, 17): 11_038, (1, 18): 0, (2, 5): 0, (3, 9): 0}


def test_prefixes_lose_no_similar_window(spark):
    """Every window at the bound has a shingle among the rarest of its item."""
    rows, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = decontam.benchmark_items(bench, 5)
    kept = decontam.prefix_shingles(own, 0.8).groupBy("item").count().collect()
    sizes = {r.item: r["count"] for r in own.groupBy("item").count().collect()}
    for row in kept:
        assert 1 <= row["count"] <= sizes[row.item] - -(-sizes[row.item] * 4 // 5) + 1


def test_shingles_are_hashed_once_per_document(spark):
    """No projection behind an exploded list of shingles makes them anew for each of them."""
    import re as regex

    rows, items = sample()
    seen = []
    original = decontam.written
    decontam.written = lambda df, name: seen.append(df) or original(df, name)
    try:
        decontam.contaminated_windows(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).count()
    finally:
        decontam.written = original
    for df in seen:
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = [len(regex.match(r"[\s:+-]*", line)[0]) for line in lines]
        for i, line in enumerate(lines):
            below = next((k for k in range(i + 1, len(lines)) if depth[k] > depth[i]), None)
            if "Project [" in line and below is not None and "Generate " in lines[below]:
                assert "transform(sequence" not in line


def test_the_pipeline_keeps_clean_rows_of_a_contaminated_id(spark, tmp_path):
    import corpus_pipeline

    item = " ".join(f"w{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item, "s"), (None, "clean text here", "s"), (7, f"so {item} so", "s"), (7, "clean too", "s"), (7, None, "s"), (8, "", "s")]
    df = docs(spark, rows, extra="contaminated_text")
    kept = corpus_pipeline.decontamination(spark, df, str(tmp_path))
    assert kept.columns == df.columns
    assert rows_of(kept, "doc_id", "text") == sorted([r[:2] for r in (rows[1], *rows[3:])], key=repr)


def test_fingerprints_match_counted_bits(spark):
    rng = random.Random(9)
    rows = [(k, rng.getrandbits(64) - (1 << 63), rng.choice([1, 1, 2, 50])) for k in range(40) for _ in range(k % 9 + 1)]
    rows += [(100, -1, 1), (100, 0, 1), (101, -1, 2), (101, 0, 1), (102, -(1 << 63), (1 << 31) - 2), (102, 1, 1)]
    found = decontam._simhash(spark.createDataFrame(rows, "id int, hash long, weight long"), ["id"])
    wanted = collections.Counter()
    for k in {r[0] for r in rows}:
        own = [(h, w) for i, h, w in rows if i == k]
        wanted[k] = sum(1 << b for b in range(64) if 2 * sum(w for h, w in own if h >> b & 1) > sum(w for _, w in own))
    assert {r["id"]: r["fingerprint"] % (1 << 64) for r in found.collect()} == wanted


def test_pairs_come_once_at_every_radius(spark):
    rng = random.Random(10)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = [(k, 7, base[k % 6] ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 3, 9, 30])))) for k in range(60)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    windows = spark.createDataFrame([(k, n, signed(x)) for k, n, x in prints], "window_id long, words int, fingerprint long")
    items = spark.createDataFrame([(k, 7, signed(x)) for k, x in enumerate(base)], "item long, words int, fingerprint long")
    for radius in (0, 2, 24, 63, 64):
        got = rows_of(decontam._candidates(windows, items, radius), "window_id", "item")
        # pairs that differ in every block share none: with 64 blocks those that differ in all bits
        near = [(k, i) for k, _, x in prints for i, y in enumerate(base) if (x ^ y).bit_count() <= min(radius, 63)]
        assert got == sorted(near, key=repr), radius


def test_no_step_has_a_plan_that_takes_much_of_the_driver(spark, monkeypatch):
    rows, items = sample()
    sizes = {}

    def noted(df, name):
        sizes[name] = len(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name)

    written = decontam.written
    monkeypatch.setattr(decontam, "written", noted)
    bench = spark.createDataFrame(items, "item_id long, text string")
    decontam.without_contaminated(docs(spark, rows), bench, by_text=True)
    assert "benchmark-similar" in sizes
    assert max(sizes.values()) < 8000, sizes
