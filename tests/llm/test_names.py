"""Generic words are learnt from the names, whatever the words are."""

import random

from tracklore.llm import names

SPEC = "row_id long, osm_way_id long, company_name string"


def invented(rnd, n):
    return ["".join(rnd.choice("bdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randint(3, 4))).capitalize() + rnd.choice("nrsk") for _ in range(n)]


def test_trades_of_another_language(spark):
    rnd = random.Random(5)
    trades, given = ["Pharmaceuticals", "Bakkerij", "Weverij", "Optics"], ["Ottoline", "Hadrian"]
    words = invented(rnd, 800)
    rows = []
    for k in range(0, 800, 2):  # firms of two words, each with three rows
        a, b = words[k], words[k + 1]
        for j in range(3):
            first = f"{rnd.choice(given)} " if j == 2 else ""
            rows.append((3 * k + j, 10 * k + j, f"{first}{a} & {b} {rnd.choice(trades)}"))
    rows += [(9001, 99001, f"{words[0]}x {words[1]} Optics"), (9002, 99002, f"Solitaire {words[1]} Optics"), (9003, 99003, f"Solitude {words[3]} Optics")]
    parts = names.name_parts(spark.createDataFrame(rows, SPEC), "company_name")
    generic = names.learn_generic(parts)
    assert {w.lower() for w in trades + given} <= generic.words and not generic.words & {w.lower() for w in words}
    got = {tuple(r) for r in names.name_pairs(spark.createDataFrame(rows, SPEC), "row_id", "company_name", "osm_way_id").collect()}
    firm = lambda i: i // 6 if i < 9000 else {9001: 0}.get(i, i)
    assert all(firm(x) == firm(y) for x, y in got) and {(0, 9001), (1, 9001), (2, 9001)} <= got


def test_all_words_tell_firms_apart(spark):
    rows = [(1, 1, "Tarvemoor & Belkilesk Pharmaceuticals"), (2, 2, "Zupandirt & Belkilesk Pharmaceuticals"), (3, 3, "TARVEMOR-BELKILESK PHARMACEUTICALS"), (4, 4, "word " * 3000), (5, 5, None)]
    got = {tuple(r) for r in names.name_pairs(spark.createDataFrame(rows, SPEC), "row_id", "company_name", "osm_way_id").collect()}
    assert got == {(1, 3)}


def test_channel_is_estimated():
    often, seldom = names.fit_channel([(0, 1, False, -2.0, 5000.0), (0, 0, False, -2.0, 5000.0)]), names.fit_channel([(0, 0, False, -2.0, 10000.0), (0, 1, False, -2.0, 10.0)])
    assert often[0][1] < seldom[0][1] and names.fit_channel([]) == (names.START, names.MERGED)


def test_parts_of_the_keys_give_the_same_classes(spark, monkeypatch):
    rnd = random.Random(9)
    words, rows = invented(rnd, 60), []
    for k in range(0, 60, 2):
        for j, name in enumerate((f"{words[k]} {words[k + 1]}", f"{words[k]} {words[k + 1]}", f"{words[k][:-1]} {words[k + 1]}", f"{words[k + 1]}{words[k]}", f"{words[k]} {words[k + 1]} {words[(k + 7) % 60]}")):
            rows.append((5 * k + j, 10 * k + j, name))
    df = spark.createDataFrame([*rows, *rows[:9]], SPEC)
    got = []
    for parts in (1, 3):
        monkeypatch.setattr(names, "KEY_PARTS", parts)
        got.append({tuple(r) for r in names.name_classes(df, "row_id", "company_name").collect()})
    assert got[0] == got[1] and len(got[0]) == len(rows)
    entity = {i: e for i, _, e in got[0]}
    assert all(entity[5 * k] == entity[5 * k + j] for k in range(0, 60, 2) for j in (1, 2, 3))
