import random

import cases

from headway.llm import substring


def brute(rows, least=3, words=20):
    """Sentences to remove by document, from all runs of all documents."""
    first, found = {}, {}
    order = sorted(rows, key=lambda r: r[0])
    for doc_id, text in order:
        parts = [s.split() for s in substring.sentences(text)]
        for at in range(len(parts)):
            if not parts[at]:
                continue
            run, stop = [], at
            while stop < len(parts) and (len(run) < words or stop - at < least):
                run += parts[stop]
                stop += 1
            if len(run) < words or stop - at < least:
                continue
            if first.setdefault(" ".join(run), (doc_id, at)) != (doc_id, at):
                found.setdefault(doc_id, set()).update(range(at, stop))
    return found


def test_sentences_add_up_to_the_text():
    for text in ("", "a", "A b. C d!  E, f\n\ng: h; i? 3.14 x", "no end", "...", " \n ", "a.b c.\n"):
        assert "".join(substring.sentences(text)) == text


def test_as_brute_force(spark):
    docs = cases.documents(spark, n=80, seed=3, awkward=False)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert want
    for r in substring.without_repeats(docs).collect():
        gone = want.get(r.doc_id, set())
        parts = substring.sentences(r.text)
        assert r.n_sentences == len(parts) and r.n_removed == len(gone)
        assert r.clean_text == "".join(p for k, p in enumerate(parts) if k not in gone)


def test_passage_without_marks_is_found(spark):
    rng = random.Random(10)
    words = lambda n: " ".join(rng.choice(cases.WORDS) + str(rng.randrange(50)) for _ in range(n))
    passage = words(100)
    rows = [(i, f"{words(60)} {passage if i % 2 else words(100)} {words(60)}", "en", "s", 0) for i in range(8)]
    out = substring.without_repeats(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert {r.doc_id for r in out if r.n_removed} == {3, 5, 7}
    assert all("".join(substring.sentences(r.text)) == r.text for r in out)


def found_runs(text):
    return {digest for _, _, digest in substring.runs(text)}


def test_no_passage_of_51_words_in_unmarked_prose_is_lost():
    rng = random.Random(11)
    vocabulary = [f"{w}{e}{k}" for w in cases.WORDS for e in ("", "s", "ed") for k in range(60)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    for _ in range(1000):
        passage = words(51)
        one, two = (f"{words(rng.randint(0, 40))} {passage} {words(rng.randint(0, 40))}" for _ in "12")
        assert found_runs(one) & found_runs(two)


def test_pieces_of_unmarked_text_are_short_and_add_up():
    rng = random.Random(12)
    for text in ("word " * 500, " ".join(rng.choice(cases.WORDS) for _ in range(900)), "字" * 400, "ก ข" * 200):
        pieces = substring.sentences(text)
        assert "".join(pieces) == text
        assert max(substring._halves(p) for p in pieces) <= 2 * substring.WINDOW


def test_copies_of_one_word_and_of_chinese_prose_are_found(spark):
    rng = random.Random(13)
    chinese = "".join(rng.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏") + ("。" if k % 19 == 18 else "") for k in range(300))
    plain = chinese.replace("。", "")
    rows = [(1, "again " * 500), (2, "again " * 500), (3, chinese), (4, "前言" + chinese), (5, plain), (6, plain)]
    docs = spark.createDataFrame([(i, t, "zh", "s", 0) for i, t in rows], cases.SCHEMA)
    out = {r.doc_id: r for r in substring.without_repeats(docs).collect()}
    assert not out[2].clean_text and out[1].clean_text.startswith("again ")
    assert out[3].clean_text == chinese and len(out[4].clean_text) < 30
    assert out[5].n_removed < out[6].n_removed and len(out[6].clean_text) < 60


def test_many_runs_of_one_text_are_merged_in_one_pass():
    runs = [(k, k + 3) for k in range(100_000)] + [(200_000, 200_005)]
    assert substring.disjoint(runs[::-1]) == [(0, 100_002), (200_000, 200_005)]
    assert substring.disjoint([]) == []


def test_planted_passage_leaves_all_but_its_first_document(spark):
    rng = random.Random(9)
    passage = cases.prose(rng, 60)
    rows = []
    for i in range(12):
        own, more = cases.prose(rng, 40), cases.prose(rng, 40)
        rows.append((i, f"{own[:-1]} {passage} {more}" if i % 3 == 0 else own + more, "en", "s", 0))
    out = substring.without_repeats(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    middle = " ".join(passage.split()[15:45])
    assert [r.doc_id for r in out if middle in " ".join(r.clean_text.split())] == [0]
    assert {r.doc_id for r in out if r.n_removed} == {3, 6, 9}
    assert all(list(r.first_ids) == [0] for r in out if r.n_removed)


def test_awkward_rows(spark):
    docs = cases.clashing(cases.documents(spark))
    out = substring.without_repeats(docs)
    assert out.count() == docs.count()
    assert out.columns[: len(docs.columns)] == docs.columns
    assert all(r.clean_text is None for r in out.filter("text IS NULL").collect())
    copy = out.filter("doc_id IS NULL AND text IS NOT NULL AND n_removed > 0")
    assert copy.count() >= 1  # a document without id comes after the others
    assert substring.without_repeats(docs.limit(0)).count() == 0
