import random

import pytest

from archivolt.llm import mojibake as M

SENTENCES = [
    "Après le résumé, la trésorerie générale a réédité le registre daté à Eastvale.", "Où qu’il fût rangé, le décret « égaré » était en règle.", "Die Änderung schien nötig, für Löhne und Gebühren der Größe.",
    "Fees of £250 were charged – “kept”, said the members’ clerk.", "El círculo de jubilados pidió años de sequía.", "A comissão não aprovou a relação. SÃO PAPÉIS – RELAÇÃO À PARTE.", "Übersicht fehlte, 20 € fehlen.",
]
DECOYS = ["Sorting key: Ä ä, Ö ö, Ü ü, ß, Ã ã, Â â, É é.", "Area factor √2, cube root ∛3.", "Годовой отчёт, папка 4", "Gifts\n├── Boxes\n└── Tapes", "Spectral lamp: 4000 Å–7000 Å", "price £2½; ref. № 14", "Caf&eacute; &#8364;"]
rnd = random.Random(4)


def text(n=6):
    return " ".join(rnd.choice(SENTENCES) for _ in range(n))


def garble(s, wrong, right):
    table = M.TABLES[wrong]
    return "".join(table[b] for b in s.encode(right))


WAYS = [("latin-1", "utf-8"), ("cp1252", "utf-8"), ("cp850", "utf-8"), ("mac_roman", "utf-8"), ("cp1251", "utf-8"), ("mac_roman", "cp1252"), ("cp1251", "cp1252"), ("cp850", "cp1252")]
CLEAN = [text() for _ in range(900)] + [text(2) + "\n" + rnd.choice(DECOYS) + "\n" + text(2) for _ in range(200)] + [d for d in DECOYS]
BROKEN = [(t, garble(t, *way)) for way in WAYS for t in (text(3) for _ in range(3))]


@pytest.fixture(scope="module")
def repairer(spark):
    rows = [(i, t) for i, t in enumerate([*CLEAN, *(g for _, g in BROKEN)])]
    counts = M.count_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return M.Repairer(M.PairModel([tuple(r) for r in counts]))


def test_clean_texts_stay(repairer):
    assert [t for t in CLEAN if repairer.repair(t)[0]] == []


def test_round_trip(repairer):
    for original, garbled in BROKEN:
        assert repairer.repair(garbled) == (True, False, original)


def test_passages_and_double_decoding(repairer):
    inside = CLEAN[0] + "\n" + garble(SENTENCES[0], "cp1252", "utf-8") + "\n" + CLEAN[1]
    assert repairer.repair(inside) == (True, False, CLEAN[0] + "\n" + SENTENCES[0] + "\n" + CLEAN[1])
    twice = garble(garble(SENTENCES[0], "cp1252", "utf-8"), "cp1252", "utf-8")
    assert repairer.repair(twice) == (True, False, SENTENCES[0])


def test_lost_characters(repairer):
    wrong, lost, _ = repairer.repair("r�sum� égaré")
    assert wrong and lost


def test_pairs_are_counted_whole(spark):
    df = spark.createDataFrame([("éa",), ("aé",), (None,), ("",)], "text string").repartition(3)
    got = {(chr(r.a), chr(r.b) if r.b >= 0 else None): r.n for r in M.count_pairs(df).collect()}
    assert got[("é", "a")] == 1 and got[("a", "é")] == 1 and got[("é", None)] == 2 and got[("a", None)] == 2


def brute(x):
    best = None
    for i in range(len(x)):
        t = 0.0
        for j in range(i, len(x)):
            t += x[j]
            if t > 0 and (best is None or t > best[0]):
                best = (t, i, j + 1)
    if best is None:
        return []
    left, right = brute(x[: best[1]]), brute(x[best[2] :])
    return left + [(best[1], best[2])] + [(a + best[2], b + best[2]) for a, b in right]


def test_segments_against_brute_force():
    for _ in range(500):
        x = [rnd.uniform(-3, 3) for _ in range(rnd.randint(0, 14))]
        assert M.segments(x) == brute(x)


def test_table(spark):
    rows = [(i, t) for i, t in enumerate(CLEAN)] + [(10_000 + i, g) for i, (_, g) in enumerate(BROKEN)] + [(-1, None), (-2, ""), (-3, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in M.find_garbled(df).collect()}
    assert set(got) == {10_000 + i for i in range(len(BROKEN))}
    assert all(got[10_000 + i].restored_text == t and got[10_000 + i].fully_restored for i, (t, _) in enumerate(BROKEN))
    assert M.find_garbled(df.limit(0)).count() == 0


@pytest.mark.parametrize("way", ["cp1252", "cp850", "mac_roman", "cp1251"])
@pytest.mark.parametrize("share", [3, 2])
def test_frequent_garbling_stays_a_case(spark, way, share):
    texts = [text(1) for _ in range(600)] + ["Fee of £5", "Où est-il né", "größer"] * 20
    rows = [(i, garble(t, way, "utf-8") if i % share == 0 else t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.restored_text for r in M.find_garbled(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: texts[i] for i, t in rows if t != texts[i]}


def test_symbols_that_look_like_sequences_are_counted():
    for t in ("4000 Å–7000 Å", "√π", "пункты А и В»", "её мнение", "l’été", "CAFÉ»"):
        assert M.without_misread(t, {}) == t
