import random
import time
from collections import Counter
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orefind.llm import garbled, mainbody, markup, mixing, neardup, subjects, terms, tokens

LONG = "word " * 60_000


def docs(spark, texts, extra=True):
    rows = [(i, t, "clash", "clash2") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "no bigint, text string, id string, term string").select("no", "text", *(("id", "term") if extra else ()))


# --- terms ---


def test_term_counts_follow_signed_deltas(spark, tmp_path):
    old = ["a b a", "b c", None, "", "d"]
    new = ["a b", "b c c", None, "x"]
    sign = lambda rows, s: docs(spark, rows).withColumn("sign", F.lit(s))
    path = f"file:{tmp_path}/s"
    state = terms.TermCounts(spark, path, buckets=4).merge(terms.term_deltas(sign(old, 1), "text"))
    terms.TermCounts(spark, path).merge(terms.term_deltas(sign(old, -1), "text"), terms.term_deltas(sign(new, 1), "text"))
    again = terms.TermCounts(spark, path)  # reopened
    fresh = terms.TermCounts(spark, str(tmp_path / "t")).merge(terms.term_deltas(sign(new, 1), "text"))
    rows = lambda s: {tuple(r) for r in s.counts().collect()}
    assert rows(again) == rows(fresh) == {("text", "a", 1, 1), ("text", "b", 2, 2), ("text", "c", 2, 1), ("text", "x", 1, 1), ("text", None, 3, 3)}
    with pytest.raises(RuntimeError):  # opened before the second merge
        state.merge(terms.term_deltas(sign(["a"], 1), "text"))
    assert terms.TermCounts(spark, str(tmp_path / "u")).counts().count() == 0


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    sign = lambda rows, s: docs(spark, rows).withColumn("sign", F.lit(s))
    state = terms.TermCounts(spark, str(tmp_path / "s"), buckets=64).merge(terms.term_deltas(sign([f"w{i}" for i in range(500)], 1), "text"))
    before = dict(state.state["folders"])
    state.merge(terms.term_deltas(sign(["w7 w7 new"], 1), "text"))
    changed = {b for b, f in state.state["folders"].items() if before.get(b) != f}
    assert 1 <= len(changed) <= 3 and len(before) > 50
    assert {tuple(r) for r in state.counts().filter("term in ('w7', 'w8', 'new')").collect()} == {("text", "w7", 3, 2), ("text", "w8", 1, 1), ("text", "new", 1, 1)}
    gone = state.merge(terms.term_deltas(sign([f"w{i}" for i in range(500)], -1), "text"), terms.term_deltas(sign(["w7 w7 new"], -1), "text"))
    assert gone.counts().count() == 0


def test_marks_and_values(spark, tmp_path):
    df = docs(spark, [" A.txt", "a.TXT ", "a.txt", "b", None, " "]).withColumn("sign", F.lit(1))
    state = terms.TermCounts(spark, str(tmp_path / "v")).merge(terms.value_deltas(df, "text"))
    got = {r["term"]: r["mark"] for r in terms.marked(state.counts(), 1, {"text": (1, 2)}).collect()}
    assert got == {"a.txt": "common", "b": "rare"}


def test_distinctive_terms(spark):
    texts = ["x x y", "y z", "y", None, "", LONG]
    got = {(r["no"], r["term"]): r for r in terms.distinctive_terms(docs(spark, texts), "no", "text").collect()}
    assert got[0, "x"]["score"] > got[0, "y"]["score"] and got[5, "word"]["tf"] == 60_000 and (3, "x") not in got
    brute = {(i, t): n for i, x in enumerate(texts) if x for t, n in Counter(x.split()).items()}
    assert {k: r["tf"] for k, r in got.items()} == brute
    few = terms.distinctive_terms(docs(spark, texts), "no", "text", min_tf=2, records=(1, 1)).collect()
    assert {(r["no"], r["term"]) for r in few} == {(0, "x"), (5, "word")}
    assert terms.distinctive_terms(docs(spark, []), "no", "text").count() == 0


# --- near duplicates ---


def brute(texts, least=30):
    bags = [(i, Counter(neardup.words_of(t))) for i, t in enumerate(texts) if t is not None and len(neardup.words_of(t)) >= least]
    return {(i, j) for (i, a), (j, b) in combinations(bags, 2) if 5 * (a & b).total() >= 4 * (a | b).total()}


def similar(spark, texts):
    pairs = neardup.similar_pairs(*neardup.similar_classes(docs(spark, texts), "no", "text"))
    return [tuple(r) for r in pairs.collect()]


def edited_texts(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(25, 60))] for _ in range(12)]
    out = []
    for words in base:
        for _ in range(5):
            w = list(words)
            for _ in range(r.randint(0, 9)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.5:
                r.shuffle(w)
            out.append(r.choice(" \t\n") .join(w).upper() if r.random() < 0.3 else " ".join(w))
    return [*out, *out[:7], None, "", " ", "short text", "w1 " * 500, "w1 " * 450, LONG]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_similar_pairs_are_found_once(spark, seed):
    texts = edited_texts(seed)
    got = similar(spark, texts)
    assert len(got) == len(set(got)) and set(got) == brute(texts)


def test_blocks_of_long_lists_lose_nothing(spark, monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(neardup, "HOT", 7)
    cloudpickle.register_pickle_by_value(neardup)  # the workers must see the small block
    try:
        texts = edited_texts(3)
        got = similar(spark, texts)
        assert len(got) == len(set(got)) and set(got) == brute(texts)
    finally:
        cloudpickle.unregister_pickle_by_value(neardup)


def test_lists_of_many_pairs_lose_nothing(spark, monkeypatch):
    from pyspark import cloudpickle

    for name, value in (("DENSE", 1), ("_ROW", 4), ("_COLUMN", 8), ("WIDE", 40)):
        monkeypatch.setattr(neardup, name, value)
    cloudpickle.register_pickle_by_value(neardup)
    try:
        texts = edited_texts(4)
        got = similar(spark, texts)
        assert len(got) == len(set(got)) and set(got) == brute(texts)
    finally:
        cloudpickle.unregister_pickle_by_value(neardup)


def test_a_comparison_in_a_long_list_is_a_few_instructions():
    draw, count = np.random.default_rng(0), 12_000
    entry = np.sort((draw.integers(220, 260, count) << 32) | (draw.integers(0, 20, count) << 2) | 3)
    sketch = [pa.array(draw.integers(-(1 << 62), 1 << 62, count) if i < 4 else np.zeros(count, np.int64)) for i in range(8)]
    rows = pa.RecordBatch.from_arrays([pa.array(np.zeros(count, np.int64)), pa.array(entry), pa.array(np.arange(count)), *sketch], ["list", "entry", "id", *neardup._SKETCH])
    x, y = draw.integers(0, 1 << 62, (128, 1)), draw.integers(0, 1 << 62, (1, 1024))
    began = time.process_time()
    for _ in range(count * count // 2 // (128 * 1024)):
        np.bitwise_count(x ^ y)
    usual = time.process_time() - began
    began = time.process_time()
    assert not list(neardup._met(4, 5)(iter([rows])))
    assert time.process_time() - began < 12 * usual


def test_short_texts_need_fewer_meetings(spark):
    texts = ["a", "a", "a b", "a b c d", "a b c d e", "b", "", None, "d c b a e f", "a a a a a a a a a", "a a a a a a a a"]
    members, links = neardup.similar_classes(docs(spark, texts), "no", "text", least_words=1)
    assert {tuple(r) for r in neardup.similar_pairs(members, links).collect()} == brute(texts, 1)


def test_large_classes_are_paired_in_blocks(spark):
    members = spark.createDataFrame([(i, 0) for i in range(25)] + [(100 + i, 100) for i in range(7)] + [(500, 500)], "id bigint, class bigint")
    links = spark.createDataFrame([(0, 100), (100, 500)], "a bigint, b bigint")
    got = [tuple(r) for r in neardup.similar_pairs(members, links, block=3).collect()]
    ids = [r[0] for r in members.collect()]
    of = lambda i: 0 if i < 100 else 100 if i < 500 else 500
    want = {(a, b) for a, b in combinations(sorted(ids), 2) if of(a) == of(b) or {of(a), of(b)} in ({0, 100}, {100, 500})}
    assert len(got) == len(want) and set(got) == want


def test_lengths_are_exact_for_long_lists(spark):
    texts = docs(spark, [f"the of w{i}" for i in range(3000)]).select("text")
    lengths = neardup.list_lengths(texts, 1)
    element = lambda w: neardup._elements([w], 1)[2]
    assert lengths(element("the"))[0] == 3000 and 1 <= lengths(element("w5"))[0] <= 5


def test_copies_classes_and_groups(spark):
    text = " ".join(f"t{i}" for i in range(40))
    near = text + " a b c"
    members, links = neardup.similar_classes(docs(spark, [text] * 30 + [near] * 20 + ["x " * 40, text + " " + "q " * 200]), "no", "text")
    assert links.count() == 1 and members.select("class").distinct().count() == 4
    got = {r["id"]: r["group"] for r in neardup.groups(members, links).collect()}
    assert got[29] == got[49] == 0 and got[50] == 50 and got[51] == 51
    assert neardup.similar_pairs(members, links).count() == 50 * 49 // 2
    assert neardup.similar_pairs(*neardup.similar_classes(docs(spark, []), "no", "text")).count() == 0


# --- markup ---


@pytest.mark.parametrize(
    ("text", "families"),
    [
        ("<p>a</p>", ["html"]), ("a &amp; b", ["html"]), ("a</span> b", ["html"]), ("# H\n\n**b**", ["markdown"]), ("see [x](http://y.example)", ["markdown"]), ("Title\n=====\n\ntext", ["markdown"]), ("a ~~b~~", ["markdown"]),
        ("== H ==\n\n# one\n# two", ["wiki"]), ("h1. H\n\n* a", ["wiki"]), ("'''b''' [[x|y]]", ["wiki"]), ("a ''b'' c", ["wiki"]), ("\\section{H} ``q''", ["latex"]), ("$x_{1}$", ["latex"]), ("a \\textbf{b}", ["latex"]),
        ("\\emph{x} <b>y</b>", ["html", "latex"]), ("3 * 2 * 5 threads took < 2 ms and > 1 ms", []), ("C:\\data\\x costs $5, later $7 [sic]", []), ("a == b holds for {x} and a_b_15", []), ("If n<83 then skip; R&D item #12", []), (None, []), ("", []), (LONG, []),
    ],
)
def test_families_of_markup(text, families):
    assert markup.found(text) == families


def test_structure_is_kept():
    kinds = lambda t: [(b["kind"], b["text"]) for b in markup.blocks(t)[1]]
    want = [("heading", "H"), ("paragraph", "a bold word"), ("item", "one"), ("code", "x = 1 * 2"), ("table", "k\tv")]
    assert kinds("# H\n\na **bold** word\n\n- one\n\n```py\nx = 1 * 2\n```\n\n| k | v |\n|---|---|") == want
    assert kinds("<h1>H</h1><p>a <b>bold</b> word</p><ul><li>one</li></ul><pre><code>x = 1 * 2</code></pre><table><tr><td>k</td><td>v</td></tr></table>") == want
    assert kinds("== H ==\na '''bold''' word\n* one\n{code}\nx = 1 * 2\n{code}\n{|\n|-\n| k || v\n|}") == want
    assert kinds("\\section{H}\na \\textbf{bold} word\n\\begin{itemize}\n\\item one\n\\end{itemize}\n\\begin{verbatim}\nx = 1 * 2\n\\end{verbatim}\n\\begin{tabular}{ll}\nk & v \\\\\n\\end{tabular}") == want
    assert kinds("\\[ E = \\alpha^{2} \\]\\cite{x}") == [("formula", "E = \\alpha^{2}")]
    assert markup.blocks(None) == ([], None) and markup.plain(None) is None and markup.blocks("")[1] == []


def test_markup_of_rows(spark):
    got = markup.clean_markup(docs(spark, ["<b>x</b>", None, "", "x", "x"]), "no", "text").orderBy("no").collect()
    assert [r["clean"] for r in got] == ["x", None, "", "x", "x"] and got[0]["markup"] == ["html"]


def test_lines_of_neighbours_by_address(spark):
    assert markup.common_lines(list("abcbdab"), list("bdcaba")) in ({1, 2, 3, 5}, {1, 2, 5, 6}, {1, 4, 5, 6}, {3, 4, 5, 6}) and markup.common_lines([], ["a"]) == set()
    rows = [(1, "Menu\nOne\nFoot", "http://a.example/x/1.html"), (2, "Menu\nTwo\n\nFoot", "HTTP://a.example/x/2.html?q"), (3, "Menu\nThree\nFoot", "http://b.example/"), (4, None, "http://a.example/x/3.html"), (5, "Menu", None), (6, "", "http://c.example/a"), (7, "", "http://c.example/b")]
    got = {r["no"]: (r["text"], r["removed"]) for r in markup.differenced(spark.createDataFrame(rows, "no bigint, text string, url string"), "no", "text", "url").collect()}
    assert got == {1: ("One", 2), 2: ("Two\n", 2), 3: ("Menu\nThree\nFoot", 0), 6: ("", 0), 7: ("", 0)}


def test_nested_commands_and_void_elements():
    assert markup.plain(markup.blocks("\\section{H}\na " + "\\emph{" * 9 + "x" + "}" * 9)[1]) == "H\na x"
    import time

    start = time.perf_counter()
    markup.found("<source src='a'>" * 20_000)
    assert time.perf_counter() - start < 5


# --- encodings ---

SENTENCE = {"de": "Später hieß es, die Köche würzten die Soßen für die Gäste. ", "fr": "Dès le début, à Nantes, les élèves étaient pressés. ", "es": "¿Fueron los señores quienes mencionó después? ", "ru": "По словам автора, письма нашли страницы в каталоге. "}


@pytest.mark.parametrize(("lang", "written", "read"), [("de", "utf-8", "cp1252"), ("fr", "utf-8", "latin-1"), ("es", "utf-8", "cp437"), ("ru", "utf-8", "cp1251"), ("ru", "utf-8", "cp866"), ("de", "utf-8", "mac-roman"), ("ru", "cp1251", "latin-1"), ("ru", "koi8-r", "cp1251"), ("de", "mac-roman", "cp1252"), ("fr", "cp1252", "cp437")])
def test_wrong_decoding_is_found_and_undone(lang, written, read):
    text = SENTENCE[lang] * 3
    bad = text.encode(written).decode(read, errors="ignore")
    assert garbled.repair(text) == (False, text)
    is_bad, got = garbled.repair(bad)
    assert is_bad
    if len(bad.encode(read, errors="ignore")) == len(text.encode(written)):
        assert got == text


def test_only_the_garbled_part_changes():
    assert garbled.repair("Grün und GrÃ¼n") == (True, "Grün und Grün")
    assert garbled.repair("twice: fÃƒÂ¼r") == (True, "twice: für")
    assert garbled.repair("Caf� x") == (True, "Caf� x")
    for fine in ("Il tempo passa. È vero che piove.", "È così. Più tardi, perché no?", "Æ er et bogstav. Å er en anden.", "x§y a±b", "3ª edição, nº 5ª. À noite.", "f(x)=∑x²≤∞, a≠b, x±y", "Þetta er ágætt. Ð og ð.", "Příliš žluťoučký kůň úpěl", "L'ÂGE DU CŒUR. Ça va, où ? Île"):
        assert garbled.repair(fine) == (False, fine)
    for fine in (None, "", "plain", "A INFORMAÇÃO SÃO PÁGINAS DO ÓRGÃO", "Ærø, Ørsted og Åbo – x", "Şişli, Đorđe: 5 µm ± 17 °C.", "Âge, Île, Œuvre.", "paid £3 or ¥3, © X, ½", "ПИСЬМА НАШЛИ СТРАНИЦЫ В КАТАЛОГЕ", LONG):
        assert garbled.repair(fine) == (False, fine)


RUSSIAN = ["Отчёты проверили серверы.", "Запросы в новом каталоге полностью сохранили документы.", "Коллекция и страницы после сбоя снова удалили записи.", "На прошлой неделе авторы нашли письма без ошибок."]


@pytest.mark.parametrize(("written", "read"), [("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("iso8859-5", "cp1251")])
@pytest.mark.parametrize("parts", [(0,), (1,), (2, 3), (0, 3), (0, 1, 2), (0, 1, 2, 3)])
def test_garbled_part_of_russian(written, read, parts):
    """One wrongly read part among right ones, or one right part among wrong ones."""
    bad = " ".join(s.encode(written).decode(read) if i in parts else s for i, s in enumerate(RUSSIAN))
    assert garbled.repair(bad) == (True, " ".join(RUSSIAN))


def test_right_cyrillic_stays():
    for fine in (" ".join(RUSSIAN), "МГУ, ЭВМ и ФГУП: 5 кВт, 7 дБ, МэВ.", "ГОСТ, СНиП, ТУ, РФ, МВД, ФСБ, НИИ и ЦК", "ЗАПРОСЫ В НОВОМ КАТАЛОГЕ\nЗапросы заменили.", "Слово — «слово»…", "Київ і Львів: їхні вулиці, ґанок, Європа, її мрії.", "Његова љубав је лепа, а њена ћерка Ђурђа живи у Београду."):
        assert garbled.repair(fine) == (False, fine)


def test_repair_of_rows(spark):
    got = garbled.repair_text(docs(spark, ["GrÃ¼n", None, "", "x", "x"]), "no", "text").orderBy("no").collect()
    assert [r["garbled"] for r in got] == [True, False, False, False, False] and got[0]["restored"] == "Grün"


# --- tokens ---


@pytest.fixture(scope="module")
def small_tree():
    return tokens.TreeEncoder(tokens.vocabulary_path(), leaf=16, window=2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab '\n\t1!é日　", "'ll", "'re", "  ", "<|endoftext|>"]), max_size=120).map("".join))
def test_tree_gives_the_ids_of_the_whole_text(text):
    tree = tokens.TreeEncoder.cached = getattr(tokens.TreeEncoder, "cached", None) or tokens.TreeEncoder(tokens.vocabulary_path(), leaf=16, window=2)
    ids = tree.encode(text)
    assert ids == tree.enc.encode_ordinary(text) and tree.decode(ids) == text


def test_ids_of_rows(spark, small_tree):
    texts = ["Hello world, it's 2024", None, "", "x", "x", LONG, "a" * 5000, " " * 3000]
    got = {r["no"]: r["ids"] for r in tokens.encode_corpus(docs(spark, texts), "no", "text").collect()}
    assert got == {i: small_tree.enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert tokens.encode_corpus(docs(spark, []), "no", "text").count() == 0


# --- mixing ---


def test_apportionment():
    assert mixing.apportion({"a": 53, "b": 24, "c": 23}, 7) == {"a": 3, "b": 2, "c": 2}
    assert mixing.apportion({"a": 1, "b": 0, "c": None}, 3) == {"a": 3, "b": 0, "c": 0} and mixing.apportion({}, 3) == {}
    many = mixing.apportion({"a": 2.0, "b": 1.0}, 30_000)
    assert many == {"a": 20_000, "b": 10_000}


def test_shares_are_met_and_caps_hold(spark):
    rows = [(i, "abcd"[min(3, i * 5 // 1000)] if i % 3 else "a", "one two three four " * (1 + i % 7)) for i in range(900)] + [(9000, "a", None), (9001, "b", ""), (9002, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.2, 9), ("c", 0.3, 1), ("none", 0.1, 2), ("d", 0.1, 3)], "source string, target_share double, max_repeats int")
    sizes = mixing.token_sizes(df, "doc_id", "text", ["source"]).cache()
    report = {r["source"]: r for r in mixing.source_report(mixing.source_tokens(sizes), targets).collect()}
    mixed = mixing.mixture(sizes, targets, "doc_id")
    own = {r["source"]: r["mixed_tokens"] for r in mixing.mixture_shares(mixed, mixing.source_report(mixing.source_tokens(sizes), targets)).collect()}
    for s, r in report.items():
        assert r["reachable"] == (r["wanted_tokens"] <= r["max_repeats"] * r["tokens"])
        want = min(r["wanted_tokens"], r["max_repeats"] * r["tokens"])
        assert abs(own[s] - want) <= 60, s
    most = {r["source"]: r["c"] for r in mixed.groupBy("source").agg(F.max("copies").alias("c")).collect()}
    assert all(most[s] <= report[s]["max_repeats"] for s in most)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mixing.mixture(sizes, targets, "doc_id").collect()))
    assert mixing.mixture(sizes.limit(0), targets, "doc_id").count() == 0


# --- pages ---

PAGE = """Home
Products
Kerfluffle
We use cookies to measure our audience.
OK, close
Home » Trees » Oaks in the old park
Oaks in the old park
The oaks of the park lost their leaves early. Nobody had noticed how the gardeners counted them until 2011-04-05.
Results
The gardeners counted forty oaks, while the visitors looked on and asked about the paths.

Advertisement
The search box on the home page returned 3 rows.
You might also like
Foxes near the lake
Bremor: herons left the island
12 comments
© 2020 Park. All rights reserved."""


def test_main_body(spark):
    rows = [(1, PAGE, "https://www.park.example/a/oaks-in-the-old-7.html"), (2, PAGE, None), (3, None, "http://x.example/"), (4, " \n ", "http://x.example/"), (5, PAGE, "/oaks.html"), (1, "The lake froze over in the night. Nobody crossed it.", "http://y.example/z")]
    df = spark.createDataFrame(rows, "no bigint, text string, url string")
    got = mainbody.page_lines(df, "no", "text", "url").collect()
    assert {r["no"] for r in got} == {1}
    body = sorted(r["line_no"] for r in got if r["body"])
    assert body == [1, 7, 8, 9, 10, 13], body
    assert 11 not in {r["line_no"] for r in got}
    assert mainbody.page_lines(df.limit(0), "no", "text", "url").count() == 0


def test_rows_of_equal_ids_and_equal_rows(spark):
    page = (1, PAGE, "https://www.park.example/a/oaks-in-the-old-7.html")
    other = (1, "The lake froze over in the night. Nobody crossed it.", "http://y.example/z")
    df = spark.createDataFrame([page, page, other], "no bigint, text string, url string")
    texts = sorted(r["text"] for r in mainbody.main_body(df, "no", "text", "url").collect())
    body = "\n".join(PAGE.split("\n")[n - 1] for n in (7, 8, 9, 10, 13))
    assert texts == sorted([body, body, other[1]])
    assert mainbody.page_lines(df, "no", "text", "url").count() == 2 * 17 + 1


def test_a_site_repeats_its_lines(spark):
    pages = spark.createDataFrame([("s", f"Zorp {i} of the site speaks\nown {chr(97 + i)}\n\n Zorp {i} of the site speaks ") for i in range(8)], "site string, text string")
    counts, whole = mainbody.site_lines(pages)
    got = {r["line"]: r["pages"] for r in counts.collect()}
    assert got[mainbody._key("Zorp 3 of the site speaks")] == 8 and got[mainbody._key("own c")] == 1 and len(got) == 9
    assert [tuple(r) for r in whole.collect()] == [("s", 8)]


def test_a_page_delivered_again_repeats_nothing(spark):
    rows = [("s", "Zorp speaks\nown a"), ("s", "Zorp speaks\nown a"), ("t", "Menu\nown b"), ("t", "Menu\nown b"), ("t", "Menu\nown c")]
    counts, whole = mainbody.site_lines(spark.createDataFrame(rows, "site string, text string"))
    assert {r["site"]: r["whole"] for r in whole.collect()} == {"s": 1, "t": 2}
    assert [(r["site"], r["line"]) for r in counts.filter("pages > 1").collect()] == [("t", mainbody._key("Menu"))]


def test_lines_that_other_sites_repeat(spark):
    rows = [(f"s{k}", f"Klick hier\nMeinung\neigen {"pqrs"[k]} {chr(97 + i)}" if i or k else "Meinung") for k in range(4) for i in range(5)] + [(f"x{k}", "Meinung") for k in range(3)]
    rows += [(f"s{k}", f"noch {chr(97 + i)} {k}") for k in range(4) for i in range(40)]
    counts, whole = mainbody.site_lines(spark.createDataFrame(rows, "site string, text string"))
    got = {r["line"]: r["share"] for r in mainbody.lines_elsewhere(counts, whole).collect()}
    assert 0.05 < got[mainbody._key("Klick hier")] < 0.15 and mainbody._key("eigen q b") not in got


HELD_OUT = """https://www.lantern.example/essays/the-mill-by-the-weir-31.html
-Skip to the essays
-Essays | Reviews | Letters | Submissions
-Lantern uses cookies so that pages load faster.
-Fine by me
+The mill by the weir
+The wheel stopped in 1951, when the last miller sold his horses. Nobody has lived there since, although the lamps are lit on feast days.
+A loud house
-Sponsored
+Everyone in the lane remembers the noise. It came through the floor at four in the morning, and the cups moved on the shelf.
+What is left of it:
+Two stones;
+A sluice gate.
+Last year the council asked for plans. There were three, and all of them wanted a restaurant.
-Share this essay
-4 letters to the editor
-More essays
-Owls over the brewery
-The ferryman's ledger
-Get our letter every Friday
-Copyright 2020 Lantern Press | Terms | Privacy
-Lantern Press, 8 Quay Street, Morrow
http://zeit.example/reise/mit-dem-rad-durch-die-heide-12
-Ressorts
-Abo
-Anmelden
-Wir nutzen Cookies, um die Seite zu verbessern.
-Einverstanden
+Mit dem Rad durch die Heide
+Der Weg beginnt hinter dem alten Bahnhof. Nach zwei Kilometern wird der Sand tief, und man steigt besser ab.
+Wo man übernachtet
+Es gibt drei Höfe mit Zimmern. Am schönsten liegt der mittlere, von dem man bis zum Moor sieht.
-Anzeige
+Am zweiten Tag geht es durch den Wald zurück. Wer früh aufbricht, hört die Kraniche.
-Teilen
-Drucken
-3 Leserbriefe
-Mehr aus der Rubrik
-Inseln im Winter
-Datenschutz | Nutzungsbedingungen
"""


def test_all_lines_of_several_sites_are_known(spark):
    counts = spark.range(3 * 70_000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("site"), F.floor(F.col("id") / 3).alias("line"), F.lit(6).cast("bigint").alias("pages"))
    whole = spark.createDataFrame([(f"s{k}", 11) for k in range(3)], "site string, whole bigint")
    assert mainbody.lines_elsewhere(counts, whole).agg(F.count("*"), F.min("share"), F.max("share")).first() == (70_000, 15 / 32, 15 / 32)


def test_less_widespread_lines_count_as_well(spark, monkeypatch):
    said = [f"Zorp {w} plim" for w in ("alpha", "beta", "gamma", "delta")]
    rows = [(100 * k + i, "\n".join([*said, f"The lake of {chr(97 + k)}{chr(97 + i)} froze over in the night. Nobody crossed it before the morning came."]), f"http://s{k}.example/{i}") for k in range(3) for i in range(9)]
    alone = "\n".join([*said, "The mill by the weir was sold in spring. Its wheel hasn't turned for a year, people say."])
    df = spark.createDataFrame([*rows, (900, alone, "http://alone.example/"), (901, alone, "http://other.example/"), (901, alone, "http://other.example/")], "no bigint, text string, url string")
    want = sorted(map(tuple, mainbody.page_lines(df, "no", "text", "url").collect()))
    assert [b for n, _, b in want if n == 900] == [False] * 4 + [True]
    for most in (1, 3, 4):
        monkeypatch.setattr(mainbody, "KNOWN_LINES", most)
        assert sorted(map(tuple, mainbody.page_lines(df, "no", "text", "url").collect())) == want


def test_held_out_pages():
    """Pages of sites and with wording that the labelled table doesn't have, without anything repeated."""
    tree, cues = mainbody.trained()
    pages: list = []
    for line in HELD_OUT.splitlines():
        if line.startswith("http"):
            pages.append((line, []))
        else:
            pages[-1][1].append(line)
    wrong, count = [], 0
    for url, lines in pages:
        body = tree(mainbody._features([x[1:] for x in lines], url, lambda x: mainbody._one(x, cues), [0.0] * len(lines))) <= 0.5
        wrong += [x for x, b in zip(lines, body, strict=True) if (x[0] == "+") != b]
        count += len(lines)
    assert len(wrong) <= count // 10, wrong


# --- subjects ---


def test_subjects_of_documents(spark):
    r = random.Random(0)
    words = {"law": "court judge verdict contract appeal statute claim".split(), "cooking": "oven sauce onion recipe soup flour pan".split(), "none": "away room booked attachment until write key".split()}
    say = lambda s: " ".join(["the", *r.choices(words[s], k=6)]) + "."
    texts, truth = [], []
    for i in range(240):
        main = ("law", "cooking", "none")[i % 3]
        other = "cooking" if main == "law" else "law"
        parts = [main] * 6 + ([other] * 3 if i % 5 == 0 and main != "none" else [other] if i % 7 == 0 and main != "none" else [])
        texts.append(" ".join(map(say, parts)))
        truth.append({s for s in set(parts) if s != "none" and parts.count(s) * 4 >= len(parts)})
    texts += [None, "", "  "]
    truth += [set()] * 3
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    areas = spark.createDataFrame([("Law", "x"), ("cooking", "y")], "subject string, description string")
    labels = spark.createDataFrame([(i, ("LAW", "cooking", "none")[i % 3], f"r{k}") for i in range(0, 60) for k in range(2) if i % 5] + [(1, None, "z"), (2, "unknown", "z")], "doc_id bigint, subject string, rater string")
    got: dict[int, set] = {}
    for row in subjects.subjects(df, areas, labels, "doc_id", "text", "lang").collect():
        got.setdefault(row["doc_id"], set()).add(row["subject"].lower())
    wrong = [i for i, want in enumerate(truth) if got.get(i, set()) != want]
    assert len(wrong) <= 5, wrong
    assert subjects.subjects(df, areas, labels.limit(0), "doc_id", "text", "lang").count() == 0
    assert subjects.sentences_of("At 3.15 he left. Why?\nTitle") == ["At 3.15 he left.", "Why?"]


def test_sentences_without_full_stop_and_headings():
    long = "Skebravur said that the threads parsed the particles because of a stale lock again"
    assert subjects.sentences_of(f"Short title\n{long}\nIt ended. Why?") == [long, "It ended.", "Why?"]
    lines = ["oven sauce onion", "recipe soup flour", "pan and oven"]
    assert subjects.sentences_of("\n".join([*lines, "It is law."])) == [*lines, "It is law."]
    assert subjects.sentences_of("判決は出た。「控訴する。」彼は言った。\n見出し") == ["判決は出た。", "「控訴する。」", "彼は言った。"]
    # a heading's words count in the terms of the document, but belong to no sentence
    ids, ends = subjects._hashed(["Verdict\nThe judge spoke.", "Onion soup\nThe oven was hot."])
    assert [len(x) for x in ids] == [4, 6] and [list(x) for x in ends] == [[3], [4]]
    batch = next(subjects._terms(iter([subjects.pa.RecordBatch.from_arrays([subjects.pa.array([0, 1]), subjects.pa.array(["Verdict\nThe judge spoke.", "Onion soup\nThe oven was hot."])], ["id", "text"])])))
    weighted = next(subjects._weights_of(SimpleNamespace(value=subjects.np.ones(subjects.TERMS)))(iter([batch])))
    place, doc = subjects._sentence_places(weighted, subjects.np.eye(subjects.TERMS, dtype="float32"))
    assert list(doc) == [0, 1] and [int((p > 0).sum()) for p in place] == [3, 4] and not place[1][ids[0][3]]
