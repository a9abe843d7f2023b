"""Greedy page operators against imperative models of their rules, on random pages."""

import random

from pyspark.sql import functions as F

from scriptorium.functions import geometry as geo
from scriptorium.functions.geometry import Box
from scriptorium.operators import layout as lo


def area(b):
    return max(0, b[2] - b[0]) * max(0, b[3] - b[1])


def inter(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def iou(a, b):
    return inter(a, b) / (area(a) + area(b) - inter(a, b)) if inter(a, b) else 0.0


def ios(a, b):
    return inter(a, b) / min(max(1, area(a)), max(1, area(b)))


def random_pages(seed, pages=40):
    rng = random.Random(seed)
    rows = []
    for page in range(pages):
        for i in range(rng.randint(1, 25)):
            x, y = rng.randrange(0, 300, 10), rng.randrange(0, 200, 3)
            rows.append((1, page, i, rng.randint(0, 1), x, y, x + rng.randint(5, 200), y + rng.randint(5, 30), rng.randint(0, 20) / 20, [rng.randint(1, 4)]))
    return rows


SCHEMA = "doc_id bigint, page int, i int, tile int, x1 int, y1 int, x2 int, y2 int, conf double, tiles array<int>"


def test_line_duplicates(spark):
    rows = random_pages(1)
    want = []
    for page in {r[1] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[1] == page), key=lambda r: (r[5], r[4], -r[8], r[3], r[2])):
            b = r[4:8]
            for k, (e, tiles) in enumerate(kept):
                o = e[4:8]
                if abs((b[1] + b[3]) / 2 - (o[1] + o[3]) / 2) <= max(b[3] - b[1], o[3] - o[1]) and (iou(b, o) >= 0.38 or ios(b, o) >= 0.72):
                    first = area(o) >= area(b) if abs(e[8] - r[8]) <= 0.08 else e[8] >= r[8]
                    kept[k] = (e if first else r, sorted({*tiles, *r[9]}))
                    break
            else:
                kept.append((r, sorted(set(r[9]))))
        want += [(page, e[2], tuple(t)) for e, t in kept]
    got = lo.dedup_lines(spark.createDataFrame(rows, SCHEMA)).select("page", "i", "tiles").collect()
    assert sorted((r[0], r[1], tuple(r[2])) for r in got) == sorted(want)


def test_reading_order(spark):
    rows = random_pages(2)
    want = {}
    for page in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == page), key=lambda r: ((r[5] + r[7]) / 2, r[4], r[2]))
        heights = sorted(r[7] - r[5] for r in own)
        n = len(heights)
        tolerance = max(8, 0.45 * (heights[n // 2] if n % 2 else (heights[n // 2 - 1] + heights[n // 2]) / 2))
        lines, centres = [], []
        for r in own:
            c = (r[5] + r[7]) / 2
            near = [(abs(c - m), k) for k, m in enumerate(centres) if abs(c - m) <= tolerance]
            if near:
                k = min(near)[1]
                lines[k].append(r)
                centres[k] = sum((x[5] + x[7]) / 2 for x in lines[k]) / len(lines[k])
            else:
                lines.append([r])
                centres.append(c)
        ordered = [x for k in sorted(range(len(lines)), key=centres.__getitem__) for x in sorted(lines[k], key=lambda x: x[4])]
        want |= {(page, r[2]): n for n, r in enumerate(ordered, 1)}
    got = lo.reading_order(spark.createDataFrame(rows, SCHEMA))
    assert {(r["page"], r["i"]): r["ord"] for r in got.collect()} == want


def test_every_line_goes_one_way(spark):
    lines = spark.createDataFrame(random_pages(3), SCHEMA)
    chosen = spark.createDataFrame([(1, p, n, list(range(n, n + 6))) for p in range(0, 40, 2) for n in (1, 4)], "doc_id bigint, page int, candidate int, lines array<int>")
    key = lambda df: {(r["page"], r["i"]) for r in df.collect()}
    routed, left = key(lo.route(lines, chosen)), key(lo.unrouted(lines, chosen))
    assert not routed & left and routed | left == key(lines)


def test_regrouping_keeps_every_line_once(spark):
    lines = spark.createDataFrame([(1, 1, i, i, f"t{i}", "text") for i in range(9)], "doc_id bigint, page int, i int, ord int, text string, type string")
    proposed = spark.createDataFrame([(1, 1, 0, "title", [4, 2, 99]), (1, 1, 1, "table", [2, 7]), (1, 1, 2, "text", [99])], "doc_id bigint, page int, b int, type string, lines array<int>")
    got = lo.regroup(proposed, lines).orderBy("n").collect()
    assert sorted(i for r in got for i in r["lines"]) == list(range(9))
    assert [(r["type"], r["lines"]) for r in got if len(r["lines"]) > 1 or r["type"] != "text"] == [("title", [4, 2]), ("table", [7])]


def test_joins_have_keys(spark):
    lines = spark.createDataFrame(random_pages(4), SCHEMA)
    boxes = lines.select("doc_id", "page", F.lit("r1").alias("region_id"), "x1", "y1", "x2", "y2", "conf")
    plan = lo.table_candidates(lines, boxes, 500, 300)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_angles_and_small_boxes(spark):
    angles = [-90.0, 90.0, 90.5, -89.5, 45.0, -45.0, 135.0, 450.0, -270.0, 0.0, 46.0]

    def model(a):
        while a <= -90:
            a += 180
        while a > 90:
            a -= 180
        return a + 90 if a < -45 else a - 90 if a > 45 else a

    df = spark.createDataFrame([(a,) for a in angles], "a double")
    assert [r[0] for r in df.select(geo.normalize_angle(F.col("a"))).collect()] == [model(a) for a in angles]
    box = spark.createDataFrame([(10.0, 10.0, 12.5, 500.0), (900.0, 500.0, 100.0, 100.0), (0.5, 0.5, 1000.0, 1000.0)], "x1 double, y1 double, x2 double, y2 double")
    got = [r[0] for r in box.select(geo.from_thousandths(Box.of(), F.lit(1000), F.lit(1000))).collect()]
    assert got[0] is None and tuple(got[1]) == (100, 100, 900, 500) and tuple(got[2]) == (0, 0, 1000, 1000)
