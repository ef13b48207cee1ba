"""Language, licences, benchmark items, quality and mixing against plain Python."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, language, licences, quality_rules
from feedloom.llm.mixing import mix
from feedloom.llm.queries import QUERIES
from tests.llm.helpers import LOWER, SF, WORD, documents, empty, odd_documents, sample


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_automaton_holds_all_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    step = language.suffix_automaton(text)

    def follows(part):
        state = 0
        for symbol in part:
            if symbol not in step[state]:
                return False
            state = step[state][symbol]
        return True

    parts = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    rng = random.Random(1)
    tried = parts | {tuple(rng.choice([1, 2, 3, 4]) for _ in range(rng.randrange(1, 5))) for _ in range(300)}
    assert {p for p in tried if follows(p)} == parts


def test_phrases_are_longest_matches():
    texts = {"aa": ["abcab dab"], "bb": ["zyx abx"]}
    built = language.build(texts)

    def plain(reference, piece):
        n, at = 0, 0
        while at < len(piece):
            end = at + 1
            while end <= len(piece) and tuple(piece[at:end]) in reference:
                end += 1
            n, at = n + 1, max(end - 1, at + 1)
        return n

    pieces = [language._symbols(t, built.codes) for t in ("abcabd zq abx", "zyx", "éé ab", "q")]
    pieces.sort(key=len, reverse=True)
    grid = np.zeros((len(pieces), max(map(len, pieces))), np.uint8)
    for i, p in enumerate(pieces):
        grid[i, : len(p)] = p
    counts = language.phrases(grid, np.array([len(p) for p in pieces]), built)
    for row, name in zip(counts, built.languages, strict=True):
        symbols = [0, *language._symbols(texts[name][0], built.codes).tolist()]
        other = max(built.codes)
        held = {tuple(symbols[i:j]) for i in range(len(symbols)) for j in range(i + 1, len(symbols) + 1)}
        held = {h for h in held if other not in h}
        assert row.tolist() == [plain(held, p.tolist()) for p in pieces]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.predict(docs, language.learn(docs), keep=["lang"])
    assert dict(out.dtypes)["held_out"] == "boolean"
    held = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] >= 0.97 and held[1] > 150
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_is_not_learned_from_held_out_rows(spark):
    docs = documents(spark, [(i, "texto uno dos tres" if i % 2 else "some text in here", "es" if i % 2 else "en", None, None) for i in range(60)])
    hidden = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert language.learn(hidden).languages == ["en", "es"]


def test_letters_beyond_a_byte():
    rng = np.random.default_rng(4)
    alphabets = {"zh": range(0x4E00, 0x5200), "ko": range(0xAC00, 0xAE00), "ja": range(0x3041, 0x3097), "ru": range(0x430, 0x450), "en": range(97, 123)}
    texts = {k: ["".join(chr(c) for c in rng.choice(v, 900)) for _ in range(3)] for k, v in alphabets.items()}
    built = language.build(texts)
    for name, (text, *_) in texts.items():
        symbols = language._symbols(text, built.codes)
        assert len(np.unique(symbols)) == len(set(text))
        counts = language.phrases(symbols[None, :], np.array([len(symbols)]), built)[:, 0]
        assert built.languages[int(np.argmin(counts))] == name and counts.min() == 1


def test_language_is_learned_from_all_over_a_text(spark):
    """Texts that begin alike, by more than the characters learned from each."""
    rng = np.random.default_rng(4)
    opening = "shared opening " * 90
    stems = {"de": ["ung", "isch", "ver", "zen", "krau"], "es": ["cion", "mente", "llo", "que", "dad"]}
    write = lambda lang, n: " ".join("".join(rng.choice(stems[lang], 3)) for _ in range(n))
    rows = [(i, f"{opening}{write(lang, 300)}", lang) for i, lang in enumerate(["de", "es"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tests = spark.createDataFrame([(i, write(lang, 40), lang) for i, lang in enumerate(["de", "es"] * 20)], docs.schema)
    out = language.predict(tests, language.learn(docs), keep=["lang"]).collect()
    assert all(r.lang_pred == r.lang for r in out)
    few = language.learn(docs, documents=3, characters=200)
    assert len(few.keys) < len(language.learn(docs).keys) / 4
    assert language.learn(docs, languages=1).languages in (["de"], ["es"])


def test_languages_that_were_not_learned_do_not_fit(spark):
    rng = np.random.default_rng(6)
    stems = {"aa": ["bor", "tim", "sel", "ka"], "bb": ["nux", "dri", "wo", "phe"], "cc": ["gyj", "zqu", "vih", "lx"]}
    write = lambda lang: " ".join("".join(rng.choice(stems[lang], 3)) for _ in range(60))
    docs = spark.createDataFrame([(i, write(lang), lang) for i, lang in enumerate(["aa", "bb"] * 100)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert 0 < model.limit < 1
    tests = [(i, write(lang), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 10)] + [(90, "123", "none"), (91, None, "none")]
    out = language.predict(spark.createDataFrame(tests, docs.schema), model, keep=["lang"]).collect()
    assert {r.lang: r.fits for r in out} == {"aa": True, "bb": True, "cc": False, "none": False}
    assert {r.lang_pred for r in out if r.lang == "cc"} <= {"aa", "bb"}


def test_the_model_needs_no_class_on_the_executors(model):
    import pickle

    assert b"feedloom" not in pickle.dumps(dict(vars(model)))


def test_language_of_odd_rows(spark, model):
    rows = odd_documents(random.Random(1)) + [(500, "1234 !!! ---", None, None, None), (500, "Ünïcödé 漢字", None, None, None)]
    out = language.predict(documents(spark, rows), model).collect()
    assert len(out) == len(rows)
    got = collections.Counter((r.doc_id, r.lang_pred == "und", r.score == 0 or r.lang_pred != "und") for r in out)
    assert got == collections.Counter((r[0], not any(c.isalpha() for c in r[1] or ""), True) for r in rows)
    assert language.predict(empty(spark), model).collect() == []
    nothing = language.learn(empty(spark))
    assert {r.lang_pred for r in language.predict(documents(spark, rows), nothing).collect()} == {"und"}


def plain_words(text):
    return licences._WORD.findall((text or "").translate(LOWER).encode())


def test_licence_phrases(spark):
    rng = random.Random(2)
    rows = odd_documents(rng)
    bits = ["CC BY", "cc-by", "General Public\nLicense", "all rights  reserved", "cc", "by", "rights", "All Rights Reserved. CC BY"]
    rows += [(600 + i, " ".join(rng.choice([sample(rng, 2), *bits]) for _ in range(12)), None, None, None) for i in range(30)]
    got = collections.Counter(tuple(r)[:6] for r in licences.scan(documents(spark, rows)).collect())
    expected = collections.Counter()
    for doc, text, *_ in rows:
        words, at, labels = plain_words(text), [], set()
        for phrase, label in licences.PHRASES.items():
            part = phrase.encode().split()
            hits = [i for i in range(len(words)) if words[i : i + len(part)] == part]
            at += hits
            labels |= {label} if hits else set()
        expected[(doc, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))] += 1
    assert got == expected
    assert licences.scan(empty(spark)).collect() == []


def test_licence_templates(spark):
    templates = {"t1": "licensed under [[the terms of]] the x license {{2}} version 2", "t2": "free [[and open]] use"}
    texts = {
        "Licensed under the X License version 2": "t1",
        "it is Licensed, under the terms of the X-License (foo bar), version 2.": "t1",
        "licensed under the terms the x license version 2": "",
        "licensed under the x license a b c version 2": "",
        "licensed under the x license version": "",
        "free use": "t2",
        "free and open use": "t2",
        "free and use": "",
        "Licensed under the x license one version 2; free and open use": "t1,t2",
    }
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.labels, r.score) for r in licences.scan(documents(spark, rows), {}, templates).collect()}
    assert got == {i: (label, 1.0 if label else 0.0) for i, label in enumerate(texts.values())}
    with pytest.raises(ValueError):
        licences.Automaton("[[maybe]] this")


def test_nested_licence_markup():
    automaton = licences.Automaton("granted [[to {{3}} persons [[or firms]]]] free of charge")

    def accepts(text):
        return automaton.accepts(iter(plain_words(text)))

    assert accepts("granted free of charge")
    assert accepts("granted to persons free of charge")
    assert accepts("granted to all such natural persons or firms free of charge")
    assert not accepts("granted to all such very natural persons free of charge")
    assert not accepts("granted or firms free of charge")
    assert not accepts("granted to 3 persons or free of charge")
    for broken in ("a [[b", "a b]] c", "a {{x}} b", "a {{2 b", "a 2}} b", "a [[b [[c]] d"):
        with pytest.raises(ValueError):
            licences.Automaton(broken)


def test_whole_licences(spark):
    bsd = licences.TEMPLATES["bsd-text"].replace("{{12}}", "The Regents of X and its contributors")
    numbered = bsd.replace("[[1]] [[a]]", "1.").replace("[[2]] [[b]]", "2.").replace("[[[[3]] [[c]]", "3.").replace("]]", "")
    two = bsd[: bsd.index("[[[[3]]")].replace("[[1]] [[a]]", "*").replace("[[2]] [[b]]", "*") + bsd[bsd.index("permission]]") + 12 :]
    mit = licences.TEMPLATES["mit-text"].replace("{{12}}", "the authors or copyright holders").replace("[[(including the next paragraph)]]", "")
    texts = [numbered.upper(), two, mit, mit.replace("sublicense", "rent"), two.replace("disclaimed", "accepted")]
    rows = [(i, f"header\n{t}\nfooter", None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r.labels.split(",") for r in licences.scan(documents(spark, rows)).collect()}
    assert ["bsd-text" in got[i] for i in range(5)] == [True, True, False, False, False]
    assert ["mit-text" in got[i] for i in range(5)] == [False, False, True, False, False]


def test_every_template_accepts_its_own_wording():
    for label, template in licences.TEMPLATES.items():
        for keep in (True, False):
            text = template.replace("[[", "").replace("]]", "") if keep else __import__("re").sub(r"\[\[.*?\]\]", "", template)
            text = __import__("re").sub(r"\{\{\d+\}\}", "filler", text)
            assert licences.Automaton(template).accepts(iter(plain_words(text))), label


def best_match(words, item):
    """Similarity of the most similar window of an item's length, and where it is."""
    n, best = min(len(item), len(words)), (0.0, 0)
    wanted = collections.Counter(tuple(item[i : i + 5]) for i in range(max(1, len(item) - 4)))
    for at in range(len(words) - n + 1):
        window = words[at : at + n]
        mine = collections.Counter(tuple(window[i : i + 5]) for i in range(max(1, len(window) - 4)))
        both = sum((mine & wanted).values())
        value = both / (sum(mine.values()) + sum(wanted.values()) - both)
        if value > best[0] + 1e-12:
            best = (value, at)
    return best


def test_decontamination(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"q{rng.randrange(400)}" for _ in range(rng.choice([2, 4, 5, 9, 30, 45])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "?!"), (7, items[7][1])]
    rows = odd_documents(rng)
    for i in range(40):
        words = items[i % 12][1].split()
        if i % 3 == 1:
            words = words[1:]
        if i % 4 == 3:
            words[-1] = "changed"
        inside = " ".join(words).upper() if i % 5 == 0 else ", ".join(words)
        before, after = (sample(rng, rng.choice([0, 20])) for _ in range(2))
        rows.append((300 + i, f"{before} {inside} {after}", None, None, None))
    out = decontaminate.matches(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = collections.Counter((r.doc_id, r.item_id, round(r.similarity, 9), r.start_word) for r in out.collect())
    expected = collections.Counter()
    for doc, text, *_ in set(rows):
        for item, wanted in items:
            words, target = plain_words(text), plain_words(wanted)
            if words and target:
                value, at = best_match(words, target)
                if value >= 0.8:
                    expected[(doc, item, round(value, 9), at)] += rows.count((doc, text, *_))
    assert sum(expected.values()) > 20
    missed = {k[:2] for k in expected} - {k[:2] for k in got}
    assert not {k[:2] for k in got} - {k[:2] for k in expected}
    assert all(best_match(plain_words(t), plain_words(w))[0] < 0.9 for d, t, *_ in rows for i, w in items if (d, i) in missed)
    assert len(missed) <= 1  # beyond the radius, which borderline windows may be
    kept = {r.doc_id for r in decontaminate.without_matches(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {r[0] for r in rows} - {k[0] for k in got}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(documents(spark, rows), none).collect() == []
    assert decontaminate.matches(empty(spark), spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_items_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 60)
    items = [(i, " ".join(f"q{i}x{k}" for k in range(10))) for i in range(6)]
    rows = [(i, "some text " + items[i][1], None, None, None) for i in range(6)]
    out = decontaminate.matches(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in out.collect()) == [(i, i) for i in range(6)]


def plain_features(text):
    text = text or ""
    words = WORD.findall(text)
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = [False] * len(words)
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            covered[i : i + 5] = [True] * 5
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = sum(covered)
    failed = len(words) < 10 or 100 * repeated > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeated, failed


def test_quality_features(spark):
    rows = odd_documents(random.Random(6)) + [(700, "a b c d e a b c d e f\nx\nx \n\nx", None, None, None), (701, "#*$%&|<> \x0b\x0c" * 9, None, None, None)]
    out = quality_rules.judge(documents(spark, rows)).collect()
    got = collections.Counter((r.doc_id, *(r[c] for c in quality_rules.BASE), r.base_failed) for r in out)
    assert got == collections.Counter((r[0], *plain_features(r[1])) for r in rows)
    assert not [r for r in out if r.base_failed and r.kept]
    assert quality_rules.judge(empty(spark)).collect() == []


def test_quality_verdicts_agree_with_labels(spark):
    out = QUERIES["op7_quality_rules"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    good, bad = out.join(labels, "doc_id").agg(F.avg(F.when(F.col("label") == 1, F.col("kept").cast("int"))), F.avg(F.when(F.col("label") == 0, F.col("kept").cast("int")))).first()
    assert good > 0.95 and bad < 0.1


def test_votes_of_one_kind_do_not_hide_another():
    n = len(quality_rules.RULES)
    clean = [quality_rules.GOOD] * n

    def bad(*rules):
        return [quality_rules.BAD if i in rules else quality_rules.GOOD for i in range(n)]

    model = quality_rules.fit([(clean, 9000), (bad(1, 5, 6), 400), (bad(2), 300), (bad(4), 20)])
    assert quality_rules.kinds_of(clean, model)[0] > 0.9
    assert max(quality_rules.kinds_of(v, model)[0] for v in (bad(1, 5, 6), bad(2), bad(4))) < 0.5
    assert sum(quality_rules.kinds_of(bad(2, 3), model)) == pytest.approx(1)


def test_mixing_odd_rows(spark, monkeypatch):
    monkeypatch.setattr("feedloom.llm.mixing.CELL_ROWS", 3)
    rows = odd_documents(random.Random(7))
    out = mix(documents(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.size, r.source) for r in out) == collections.Counter((r[0], len(WORD.findall(r[1] or "")), r[3]) for r in rows)
    total = sum(r.size for r in out)
    by = collections.defaultdict(list)
    for r in out:
        by[r.source].append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for source in by.values():
        size = sum(r.size for r in source)
        assert {r.source_size for r in source} == {size}
        assert abs(sum(r.taken for r in source) - source[0].target) <= max(r.size for r in source) / 2 + 1e-6
        assert all(r.taken <= 2 * r.size for r in source) and source[0].target <= 2 * size + 1e-6
    again = mix(documents(spark, rows[::-1])).collect()
    assert collections.Counter(map(tuple, out)) == collections.Counter(map(tuple, again))
    assert mix(empty(spark)).collect() == []
    blank = mix(documents(spark, [(1, None, "a", "s", 1), (2, " ", "a", None, 1)])).collect()
    assert sorted((r.doc_id, r.target, r.taken) for r in blank) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mixing_by_weight(spark):
    rows = [(i, "w " * 10, "en", "s", 1) for i in range(600)] + [(i, "w " * 10, "en", "t", 1) for i in range(600, 4000)]
    docs = documents(spark, rows).withColumn("pull", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    out = mix(docs, weights=(1, 1), share=0.5, weight="pull").where("source = 't'").groupBy(F.expr("doc_id % 2")).agg(F.avg("copies")).collect()
    means = {r[0]: r[1] for r in out}
    assert 2.2 < means[0] / means[1] < 4
