import random

from archivolt.llm import leak as L

WORDS = [f"w{i}" for i in range(400)]
rnd = random.Random(11)
ITEMS = [(i, " ".join(rnd.choice(WORDS) for _ in range(90))) for i in range(20)]
FINDER = L.LeakFinder(ITEMS)


def found(text):
    return {f[0] for f in FINDER.find(text)}


def passage(item, start, n):
    return ITEMS[item][1].split()[start : start + n]


def noise(n):
    return [f"n{rnd.randrange(10**6)}" for _ in range(n)]


def around(words):
    return " ".join(noise(30) + words + noise(30))


def test_length():
    assert found(around(passage(3, 10, 20))) == {3}
    assert found(around(passage(3, 10, 19))) == set()
    assert found(" ".join(passage(3, 0, 90))) == {3}
    assert found(around(passage(3, 10, 19) + noise(5) + passage(5, 0, 19))) == set()


def test_edits_up_to_one_word_in_ten():
    """Edits at every inner place: a passage begins and ends with words of the item."""
    for trial in range(300):
        n = rnd.randint(20, 60)
        words = passage(trial % 20, rnd.randint(0, 30), n)
        inner = words[1:-1]
        for _ in range(n // 10):
            at = rnd.randrange(0, len(inner) - 1)
            kind = rnd.randrange(3)
            inner[at : at + (kind != 1)] = noise(1) if kind < 2 else []
        assert found(around(words[:1] + inner + words[-1:])) == {trial % 20}, trial


def test_edit_at_every_inner_place():
    words = passage(6, 10, 20)
    for at in range(1, 19):
        assert found(around(words[:at] + noise(1) + words[at + 1 :])) == {6}, at


def test_items_that_repeat_themselves():
    """An item of recurring phrases, far longer than what is quoted of it."""
    phrase = [f"p{i}" for i in range(8)]
    item = [w for n in range(300) for w in (*phrase, f"q{n % 7}")][:2400]
    finder = L.LeakFinder([(1, " ".join(item))])
    for n in (20, 64, 160):
        assert {f[0] for f in finder.find(around(item[900 : 900 + n]))} == {1}
    assert finder.find(around(phrase + noise(1) + phrase)) == []
    assert len(finder.find(" ".join(item * 3))) >= 1


def test_every_passage():
    text = around(passage(2, 0, 25)) + " " + around(passage(2, 50, 30)) + " " + around(passage(2, 0, 25))
    got = FINDER.find(text)
    assert [(n, e) for _, n, e, _, _ in got] == [(25, 0), (25, 0), (30, 0)]
    assert len({start for *_, start, _ in got}) == 3


def test_signs_that_look_like_tags():
    words = passage(8, 5, 22)
    text = "for x<y and z > w, a <b c d> " + around(words) + " <a href='" + "u" * 400 + "'>end</a>"
    ((_, n, edits, start, end),) = FINDER.find(text)
    assert (n, edits) == (22, 0) and text[start:end].split() == words
    assert L.words(text)[-1] == "end" and "xy" in L.words(text)


def test_too_many_edits():
    words = passage(4, 0, 24)
    for at in (5, 10, 15, 20):
        words[at] = "changed"
    assert found(around(words)) == set()


def test_case_punctuation_lines_and_markup():
    words = passage(7, 20, 25)
    text = around(words).upper().replace(" ", ",\n ", 3)
    assert found(text) == {7}
    styled = " ".join(f"<b>{w}</b>" if i == 9 else f"“{w}”," for i, w in enumerate(words))
    assert found("x " + styled) == {7}
    assert L.words("£75,025 cross-reference re-\nread A&amp;B") == ["75025", "crossreference", "reread", "ab"]


def test_offsets_point_into_the_original():
    words = passage(9, 5, 22)
    text = "<p>Größe – ﬁn&nbsp;x</p> " + around(words)
    (_, n, edits, start, end), = FINDER.find(text)
    assert (n, edits) == (22, 0) and text[start:end].split() == words
    assert [w for w, _, _ in L.placed_words(text)] == L.words(text)


def test_table(spark):
    docs = spark.createDataFrame([(1, around(passage(0, 0, 30))), (1, around(passage(0, 0, 30))), (2, None), (3, ""), (4, "x " * 60_000), (5, around(passage(1, 0, 40) + passage(2, 0, 40)))], "doc_id long, text string")
    items = spark.createDataFrame([*ITEMS, (99, None), (98, ITEMS[0][1])], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in L.find_leaks(docs, items).collect())
    assert got == [(1, 0), (1, 0), (1, 98), (1, 98), (5, 1), (5, 2)]
    assert L.find_leaks(docs.limit(0), items).count() == 0 and L.find_leaks(docs, items.limit(0)).count() == 0


def test_parts(spark, monkeypatch):
    monkeypatch.setattr(L, "PART_WORDS", 500)
    monkeypatch.setattr(L, "CHUNK_CHARS", 2000)
    docs = spark.createDataFrame([(i, around(passage(i, 0, 30))) for i in range(20)], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in L.find_leaks(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect())
    assert got == [(i, i) for i in range(20)]


def brute_force(ws, item):
    """Whether some 20 words or more of the item align with the text at no more edits than one in ten."""
    for p in range(len(item)):
        for q in range(p + 20, len(item) + 1):
            a = item[p:q]
            for d in range(len(ws)):
                if ws[d] != a[0]:
                    continue
                row = list(range(len(a) + 1))
                for e in range(d, min(len(ws), d + len(a) + len(a) // 10)):
                    last, row[0] = row[0], e - d + 1
                    for j, w in enumerate(a, 1):
                        last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (ws[e] != w))
                    if row[-1] * 10 <= len(a) and ws[e] == a[-1]:
                        return True
    return False


def test_against_brute_force():
    local = random.Random(5)
    for trial in range(60):
        item = [local.choice("abcdefghij") for _ in range(30)]
        text = [local.choice("abcdefghij") for _ in range(8)] + item[local.randrange(8) : local.randrange(20, 30)] + [local.choice("abcdefghij") for _ in range(8)]
        for _ in range(local.randrange(4)):
            text[local.randrange(len(text))] = local.choice("abcdefghij")
        assert bool(L.LeakFinder([(1, " ".join(item))]).find(" ".join(text))) == brute_force(text, item), trial
