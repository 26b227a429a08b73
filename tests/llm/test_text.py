"""Decontamination, language identification, toxicity, page extraction and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from civiq.llm import decontam, langid, toxicity, wrappers
from tests.llm.conftest import LONG, ODD
from tests.llm.test_dedup import brute_components, brute_lines, shingle_texts


def least_distance(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != x)))
        before = row
    return min(before)


def test_bit_parallel_distance_is_the_table_s():
    r = random.Random(1)
    for _ in range(300):
        item = "".join(r.choice("abc") for _ in range(r.randint(1, 30)))
        text = "".join(r.choice("abc") for _ in range(r.randint(0, 60)))
        assert decontam.best_end(item, text)[0] == least_distance(item, text)


def test_every_occurrence_within_the_budget_is_found():
    r = random.Random(2)
    words = ["the", "river", "stone", "market", "green", "letter", "under", "window", "seven", "paper"]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(8, 30)))) for i in range(12)]
    compiled, automaton = decontam.compile_items(items)
    for _ in range(150):
        number, item = r.choice(items)
        chars = list(item)
        for _ in range(r.randint(0, len(item) // 6)):
            at = r.randrange(len(chars))
            chars[at] = r.choice(["", "x", chars[at] + "y"])
        text = " ".join(r.choice(words) for _ in range(40)) + " " + "".join(chars) + " " + " ".join(r.choice(words) for _ in range(40))
        form = decontam.normal_form(text)
        want = {}
        for i, t in items:
            own = decontam.normal_form(t)
            distance = least_distance(own, form)
            if distance <= decontam.budget(len(own) - 2):
                want[i] = distance
        got = decontam.find(text, compiled, automaton)
        assert {m[0]: m[1] for m in got} == want
        for i, distance, start, end in got:
            assert least_distance(decontam.normal_form(dict(items)[i]), form[start:end]) == distance


def test_matches_of_odd_rows(llm, odd, none):
    items = llm.createDataFrame([(1, "Alpha, BETA shared-line of seven plain words!"), (2, None), (3, ""), (4, "?!"), (5, "kurz")],
                                "item_id long, text string")
    rows = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontam.matches(odd, items).collect())
    assert rows == [(0, 5), (1, 1), (9, 5), (10, 5)]
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in decontam.matches(odd, items, block_chars=1).collect()) == rows
    kept = decontam.keep_clean(odd, items, block_chars=1)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 4
    assert decontam.matches(none, items).count() == 0
    assert decontam.matches(odd, items.where("false")).count() == 0
    assert decontam.keep_clean(odd, items.where("false")).count() == len(ODD)


WORDS = {"en": "the water house under green stone with morning", "de": "das Wasser Haus unter grün Stein mit Morgen über",
         "fr": "de l'eau maison sous vert pierre avec matinée où"}


def language_rows(n, seed=3):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(WORDS[g].split()) for _ in range(r.randint(4, 30))), g)
            for i, g in enumerate(r.choice(sorted(WORDS)) for _ in range(n))]


def test_held_out_languages_are_told(make, odd, none):
    model = langid.train(make(language_rows(240)), rows_per_language=60)
    fresh = language_rows(120, 8)
    got = {r["doc_id"]: r for r in langid.predict(make(fresh), model).collect()}
    assert np.mean([got[i]["lang_pred"] == g for i, _, g in fresh]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.count_nonzero(model.weights) < model.weights.size / 50
    rows = langid.predict(odd, model).collect()
    told = {(r["doc_id"], r["lang_pred"], r["score"]) for r in rows if r["lang_pred"] == "und"}
    assert len(rows) == len(ODD) and told == {(i, "und", 0.0) for i in (3, 4, 5, 6, None)}
    assert {r["doc_id"] for r in langid.keep_identified(odd, model, 0.0).collect()} == {1, 2, 7, 8, 9, 10, 11, None}
    assert langid.predict(none, model).count() == langid.keep_identified(none, model, 0.5).count() == 0


def test_a_model_without_labels_tells_nothing(none, odd):
    model = langid.train(none)
    assert model.languages == () and {r["lang_pred"] for r in langid.predict(odd, model).collect()} == {"und"}


def test_grams_ignore_case_digits_and_runs_of_blanks():
    letters = langid.letter_table()
    a, b = langid.gram_counts("Die  Straße, 12 Häuser", letters), langid.gram_counts("die straße häuser", letters)
    assert (a == b).all() and langid.gram_counts("12 !", letters) is None


def test_folding_reads_look_alikes():
    assert toxicity.folded_words("1D10T іdіоt !diot p@thetic wow! 10") == ["idiot", "idiot", "idiot", "pathetic", "wow", "io"]


def toxic_rows(n, seed=6):
    r = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ba", "do", "lu", "mer", "san") for b in ("ti", "ren", "lo", "kus")]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(5, 60))]
        y = int(r.random() < 0.25)
        if y:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "m0ron", "Scum"]))
        elif r.random() < 0.15:
            words[2:2] = ["pond", "scum"]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, y))
    return rows, labels


def test_held_out_toxicity(llm, make, odd, none):
    rows, labels = toxic_rows(600)
    truth = llm.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(make(rows[:450]), truth.where("doc_id < 450"))
    assert " idiot " in model["weights"] and "pond scum" in model["exceptions"]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(make(rows[450:]), model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels[450:]]) > 0.97
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert len(scored) == 12 and all(0 <= s <= 1 for s in scored.values()) and scored[3] == scored[4] < 0.5
    assert toxicity.score(none, model).count() == 0


def test_toxicity_without_labels(llm, odd, none):
    empty = llm.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] < 0.5 for r in toxicity.score(odd, toxicity.train(none, empty)).collect()} == {True}


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Site name</a></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Big&nbsp;&amp; <i>bold</i></h1></header><p>First
   line<br>goes on <b>here.<p>Second one.<ul><li>point a<li>point b</ul><form><input>Sign up</form><div class="ad">Buy!</div>
<section id="comments"><p>I agree</p></section></article><aside>Most read</aside><footer>&copy; all"""


def test_text_of_one_page():
    assert wrappers.main_text(wrappers.parse(PAGE), set()) == "Big & bold\n\nFirst line goes on here.\n\nSecond one.\n\npoint a\n\npoint b"
    assert wrappers.main_text(wrappers.parse(None), set()) == wrappers.main_text(wrappers.parse(""), set()) == ""
    assert wrappers.main_text(wrappers.parse("plain &lt;text&gt; &am"), set()) == "plain <text> &am"


def test_a_head_ends_without_its_end_tag():
    head = "<!DOCTYPE html><html><head><title>t</title><meta charset=utf-8><noscript><p>No script</p></noscript><style>p{}</style>"
    for rest in ("<body><p>Text</p></body></html>", "<p>Text", "<b>Text</b>", "Text", "</head><body>Text", "<body><link href=x>Text",
                 "<script>var a;</script>\n<article><p>Text</p></article>", "<noscript>none<body><p>Text"):
        assert wrappers.main_text(wrappers.parse(head + rest), set()) == "Text", rest


def test_matching_keeps_order_and_is_largest():
    a = wrappers.parse("<body><div class=x><p>1</p></div><div class=y></div><section><p>2</p></section></body>").shape()
    b = wrappers.parse("<body><div class=y></div><div class=x><p>1</p></div><table></table><section><p>2</p></section></body>").shape()
    found = wrappers.align(a, b)
    keys_a, keys_b = wrappers.tree_of(a)[0], wrappers.tree_of(b)[0]
    assert all(keys_a[i] == keys_b[j] for i, j in found.items())
    assert {keys_a[i] for i in found} == {"page", "body", "div.x", "p", "section"} and len(found) == 6
    assert wrappers.align(a, a) == {i: i for i in range(len(keys_a))}


def test_constant_slots_of_a_host_are_template(llm):
    page = "<body><div class=top>Same words on each page</div><div class=story><p>Story {0} here</p><p>Line two</p></div></body>"
    rows = [(i, f"http://h{i % 2}.example/{i}", page.format(i)) for i in range(8)]
    rows += [(20, None, None), (21, "http://one.example/", page.format("x")), (22, "odd url", ""), (23, "http://h0.example/z", "<p>" + LONG)]
    rows += [rows[0]]
    got = {}
    for r in wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert got[0] == ["Story 0 here\n\nLine two"] * 2 and got[7] == ["Story 7 here\n\nLine two"]
    assert got[21] == ["Same words on each page\n\nStory x here\n\nLine two"] and got[20] == got[22] == [""]
    assert got[23] == [LONG]
    assert wrappers.extract(llm.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(llm, pages):
    rows = [(i, f"http://host.example/{i}", p) for i, p in enumerate(pages)]
    found = wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_constant_text_of_a_wrapper_leaves_what_varies_below(llm):
    page = "<body>Skip to content<div class=box>{0}</div></body>"
    assert texts_of(llm, [page.format(f"<p>Story {i}</p><p>More {i}</p>") for i in range(4)]) == [
        f"Story {i}\n\nMore {i}" for i in range(4)]
    page = "<article><h1>Title {0}</h1><div class=body>Share this<p>Story {0}</p></div><div class=end>All<p>rights</p></div></article>"
    assert texts_of(llm, [page.format(i) for i in range(4)]) == [f"Title {i}\n\nStory {i}" for i in range(4)]


def test_copies_of_a_page_are_no_template(llm):
    copy = "<body><h1>Notice</h1><div class=text>The story of the copies</div></body>"
    others = [f"<body><h1>Title {i}</h1><section><p>Story {i}</p></section></body>" for i in range(3)]
    assert texts_of(llm, [copy] * 5 + others) == ["Notice\n\nThe story of the copies"] * 5 + [f"Title {i}\n\nStory {i}" for i in range(3)]


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_stages_take_odd_rows(llm, request, kind, tmp_path):
    docs = request.getfixturevalue(kind)
    llm.createDataFrame([(1, "gamma delta passage")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns, out = docs.columns, f"{tmp_path}/{at}"
        stage(llm, docs, str(tmp_path)).write.parquet(out)
        docs = llm.read.parquet(out)
        assert docs.columns == columns or at == len(corpus_pipeline.STAGES) - 1
    assert (docs.count() > 0) == (kind == "odd")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def stage_rows(seed=23):
    """Texts over ten words each, so that a few new words change a line's words but few shingles; copies; one leak."""
    r, texts = random.Random(seed), []
    for family in range(5):
        base = [f"f{family}x{r.randrange(10)}" for _ in range(300)]
        texts += [" ".join(base), " ".join(base)]
        for new in (3, 5, 6, 9):
            other = list(base)
            for at in range(new):
                other[20 + 30 * at] = f"new{family}n{new}n{at}"
            texts.append(" ".join(other))
    texts += ["before the leak stands this\nseven green letters under the old market window\nand after it that", ""]
    r.shuffle(texts)
    return [(i, t, "en") for i, t in enumerate(texts)]


def test_stages_keep_what_brute_force_keeps(llm, make, tmp_path):
    leak = "seven green letters under the old market window"
    llm.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = stage_rows()
    gone = brute_lines(rows)
    want = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[i, t]) for i, t, _ in rows}
    want = {i: t for i, t in want.items() if t.strip() or not gone[i, rows[i][1]]}  # without a word from the start: stays
    line_kept = dict(want)
    order = sorted(want)
    root = brute_components([want[i] for i in order])
    want = {i: want[i] for at, i in enumerate(order) if root[at] == at}
    near_kept = dict(want)
    want = {i: t for i, t in want.items() if leak not in t}
    sets = [shingle_texts(t) for t in line_kept.values()]
    assert sum(0.8 <= len(a & b) / len(a | b) < 0.95 for at, a in enumerate(sets) for b in sets[:at]) >= 5
    assert len(rows) > len(line_kept) > len(near_kept) > len(want)
    docs = make(rows)
    expected = {"line_dedup": line_kept, "simhash_near_dedup": near_kept, "decontamination": want}
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        stage(llm, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = llm.read.parquet(f"{tmp_path}/{name}")
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected[name], name
