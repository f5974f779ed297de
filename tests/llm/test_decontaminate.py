from __future__ import annotations

import random

from helpers import documents, edit_distance, edit_distance_in

from surfacekit.llm.decontaminate import best_match, contaminated, myers, normal, pieces


def change(text, seed, edits):
    rnd, out = random.Random(seed), list(text)
    for _ in range(edits):
        at = rnd.randrange(len(out))
        out[at : at + 1] = rnd.choice([[], ["#"], [out[at], "+"]])
    return "".join(out)


def random_text(seed, n, letters="abcdefgh "):
    rnd = random.Random(seed)
    return "".join(rnd.choice(letters) for _ in range(n))


def test_myers_equals_dynamic_programming():
    for k in range(200):
        item, text = random_text(k, 1 + k % 90, "abc "), random_text(1000 + k, k % 120, "abc ")
        if text:
            assert min(myers(item, text)) == min(edit_distance_in(item, text), len(item))


def test_best_match_reports_a_substring_at_that_distance():
    for k in range(100):
        item = random_text(k, 60)
        text = random_text(k + 1, 40) + change(item, k, k % 7) + random_text(k + 2, 30)
        d, a, b = best_match(item, text, 12)
        assert d == edit_distance_in(item, text)
        assert edit_distance(item, text[a:b]) == d
    assert best_match("abcdef", "zzzzzz", 2) is None


def test_pieces_cover_the_item():
    assert "".join(p for _, p in pieces("abcdefghij", 3)) == "abcdefghij" and len(pieces("abcdefghij", 3)) == 4
    assert pieces("ab", 0) == [(0, "ab")]


def tables(spark):
    items = [(k, random_text(50 + k, 80 + 11 * k)) for k in range(12)] + [(90, None), (91, "  "), (92, "Exact!")]
    rows = [(k, random_text(500 + k, 300) + " " + change(items[k % 12][1], k, k // 6) + "\n" + random_text(700 + k, 200)) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "say EXACT!  now"), (103, items[3][1].upper().replace(" ", " \n ")), (103, "clean"), (None, items[0][1])]
    return items, rows


def test_found_pairs_equal_brute_force(spark):
    items, rows = tables(spark)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    for block_chars in (4_000_000, 300):
        got = contaminated(documents(spark, rows, "item_id distance"), bench, rate=0.08, block_chars=block_chars)
        assert got.columns == ["doc_id", "item_id", "distance", "start", "end"]
        got = sorted(((r[0], r[1], r[2]) for r in got.collect()), key=str)
        want = []
        for i, t in rows:
            for item_id, item in items:
                item, text = normal(item), normal(t)
                if item and text and (d := edit_distance_in(item, text)) <= int(len(item) * 0.08):
                    want.append((i, item_id, d))
        assert got == sorted(want, key=str) and len(got) > 20


def test_empty_tables(spark):
    items, rows = tables(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contaminated(documents(spark, []), bench).count() == 0
    assert contaminated(documents(spark, rows), bench.limit(0)).count() == 0
