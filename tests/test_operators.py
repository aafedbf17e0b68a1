"""Hand-derived cases and comparisons with Python's own expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from inkwright.functions import folds
from inkwright.functions import text as T
from inkwright.operators import blocks as B
from inkwright.operators import chapters, context, entities, epub, flags, layout, render, rules, spell
from inkwright.plans import inputs, pipeline, registry
from inkwright.sources import readers


def one(spark, value, change):
    return spark.createDataFrame([(value,)], "v string").select(change(F.col("v")).alias("r")).first()["r"]


def many(spark, values, change):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", change(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


# ---- rules


def test_rule_table_has_all_rules_and_live_ones_are_enough():
    table = rules.rule_table()
    assert len(table) == 209
    live = rules.live_rules(table)
    assert len(live) < len(table)
    full, short = (rules._compiled(r, "compat") for r in (table, live))
    rng = random.Random(3)
    pieces = [r.sql_trigger() for r in table] + [" ", ", ", ".", "стол", "Ъ", "объект"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(12))
        assert rules.rewrite(text, full) == rules.rewrite(text, short)


@pytest.mark.parametrize("text, wanted", [("объект", "обект"), ("богатнаго!", "богатного."), ("домъ", "дом")])
def test_rules_compatible(spark, text, wanted):
    assert one(spark, text, rules.apply_rules)["text"] == wanted


def test_rules_strict_dot(spark):
    assert one(spark, "богатнаго! богатнаго.", lambda c: rules.apply_rules(c, mode="strict"))["text"] == "богатнаго! богатного."


def test_all_live_rules_fire_on_the_derived_input():
    fired = set()
    steps = rules._compiled(rules.rule_table(), "compat")
    for doc in range(209 * 4):
        text = "анат " + inputs.LEFT[doc // 209 % 4] + rules.rule_table()[doc % 209].sql_trigger() + inputs.RIGHT[doc // 209 % 4]
        for k, (find, new) in enumerate(steps):
            before = text
            text, n = rules.rewrite(text, [(find, new)])
            if n:
                fired.add(k)
            assert n or text == before
    assert len(fired) == 190


# ---- text


def test_cases(spark):
    assert one(spark, '"слово"', T.normalize_punct) == "«слово»"
    assert one(spark, "В ы р е з к а", T.join_spaced_letters) == "Вырезка"
    assert one(spark, "и я в доме", T.close_small_gaps) == "иявдоме"
    assert one(spark, "и я в доме", T.cleanup) == "ияв доме"
    assert one(spark, "па дитя, то стене", T.fix_ocr) == "на дитя, по стене"
    assert one(spark, "&amp;lt;b&amp;gt;", T.unescape_html) == "<b>"
    assert one(spark, "сoль salt", T.mixed_latin_to_cyrillic) == "соль salt"
    assert one(spark, None, T.cleanup) == ""
    assert many(spark, ["Vivid x", "глава 3", "* * *", "слово", ""], T.section_heading) == [True, True, True, False, False]


def _python_punct(t):
    """Punctuation by the sentence: what stands around each dash, dot, comma and quote decides, one character at a time."""
    cyrillic = lambda c: "а" <= c.lower() <= "я" or c in "Ёё"

    def dashes(t):
        out = ""
        while "—" in t:
            before, _, t = t.partition("—")
            out, t = (out + before).rstrip() + " — ", t.lstrip()
        return out + t

    def ellipses(t):
        parts = re.split(r"(\.+)", t)
        return "".join("…" if p == "..." else p for p in parts)

    def lone_hyphens(t):
        at, out = 0, ""
        while at < len(t):
            mid = t[at : at + 3]
            if len(mid) == 3 and mid[1] == "-" and mid[0].isspace() and mid[2].isspace() and at and not t[at - 1].isspace() and at + 3 < len(t) and not t[at + 3].isspace():
                out, at = out + " — ", at + 3
            else:
                out, at = out + t[at], at + 1
        return out

    def double_hyphens(t):
        at, out = 0, ""
        while at < len(t):
            if t[at : at + 2] == "--" and at and t[at - 1].isspace() and at + 2 < len(t) and t[at + 2].isspace():
                out, at = out + " — ", at + 2
            else:
                out, at = out + t[at], at + 1
        return out

    def no_space_before(t):
        out = ""
        for c in t:
            out = (out.rstrip() if c in ",.:;?!…»)" else out) + c
        return out

    def space_after(t, marks, unless=lambda c: False):
        return "".join(c + " " if c in marks and k + 1 < len(t) and cyrillic(t[k + 1]) and not (k and unless(t[k - 1])) else c for k, c in enumerate(t))

    def one_blank(t):
        out = ""
        for run in re.findall(r"[ \t]+|[^ \t]+", t):
            out += " " if len(run) > 1 and run[0] in " \t" else run
        return out

    def quotes(t, mark, left, right):
        out, parts = "", t.split(mark)
        k = 0
        while k < len(parts):
            out += parts[k]
            if k + 2 < len(parts) and parts[k + 1]:
                out, k = out + left + parts[k + 1] + right, k + 2
            elif k + 1 < len(parts):
                out, k = out + mark, k + 1
            else:
                k += 1
        return out

    t = double_hyphens(lone_hyphens(ellipses(dashes(t.replace("–", "—")))))
    t = space_after(space_after(no_space_before(t), ".;:?!…"), ",", str.isdigit)
    return quotes(quotes(one_blank(t), '"', "«", "»"), "'", "„", "“").strip()


def test_punct_against_python(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(' \t\n.,-–—"\'…!»)3абВxY') for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    assert many(spark, texts, T.normalize_punct) == [_python_punct(t) for t in texts]


def test_linebreaks_are_idempotent(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(" \t\n\r-аб­x.") for _ in range(30)) for _ in range(300)]
    once = many(spark, texts, T.normalize_linebreaks)
    assert all("\r" not in t and "­" not in t for t in once)
    assert many(spark, [t for t in once if "-" not in t], T.normalize_linebreaks) == [t for t in once if "-" not in t]


def test_colors():
    assert T.parse_color("#fa0") == (255, 170, 0)
    assert len(T.parse_palette("#000, fff;123456 abc def")) == 5
    with pytest.raises(ValueError):
        T.parse_palette("#000")


# ---- folds


def test_chunks(spark):
    chunks = lambda v, n: one(spark, v, lambda c: folds.chunk_paragraphs(c, n))
    assert "".join(chunks("a\n\nb", 100)) == "a\n\nb\n\n"
    assert chunks("x" * 50, 10) == ["x" * 50 + "\n\n"]
    assert chunks("aa\n\nbb\n\ncc", 8) == ["aa\n\nbb\n\n", "cc\n\n"]


def test_patches(spark):
    def patched(text, matches):
        df = spark.createDataFrame([(text, matches)], f"t string, m {spell.MATCHES}")
        return df.select(folds.apply_matches(F.col("t"), F.col("m"))).first()[0]

    m = lambda o, n, *v: {"offset": o, "length": n, "replacements": [{"value": x} for x in v], "rule": {"id": "SPACE", "description": ""}}
    assert patched("abcdef", [m(0, 4, "X"), m(2, 3, "Y")]) == "Xef"
    assert patched("abcdef", [m(0, 4), m(2, 3, "Y")]) == "abYf"
    assert patched("abc", None) == "abc"


# ---- blocks


def test_merging(spark):
    rows = [("d", 0, "paragraph", "раз-"), ("d", 1, "paragraph", "два."), ("d", 2, "paragraph", "три"), ("d", 3, "heading", "H"), ("d", 4, "paragraph", "х.")]
    df = spark.createDataFrame(rows, "doc_id string, block_id int, role string, text string")
    found = [(r.role, r.text) for r in B.merge_paragraphs(df).orderBy("merged_id").collect()]
    assert found == [("paragraph", "раздва."), ("paragraph", "три"), ("heading", "H"), ("paragraph", "х.")]


def test_html_blocks(spark):
    html = "<h2 a='1'>Т <mark>и</mark>&amp;lt;</h2><p>раз\n два</p><p> </p><param name=x>три</p>"
    pages = spark.createDataFrame([(1, html), (2, "<pre>РАЗ\n\nдва три.</pre>"), (3, None)], "page_id int, html string")
    found = [(r.page_id, r.role, r.text) for r in B.html_blocks(pages).orderBy("page_id", "block_id").collect()]
    assert found == [(1, "heading", "Т и<"), (1, "paragraph", "раз два"), (1, "paragraph", "три"), (2, "heading", "РАЗ"), (2, "paragraph", "два три.")]


def test_chapters(spark):
    rows = [("d", k, r, t) for k, (r, t) in enumerate([("paragraph", "а" * 300), ("heading", "Один"), ("heading", "Два"), ("paragraph", "б" * 300), ("paragraph", "в" * 300), ("heading", " ")])]
    df = spark.createDataFrame(rows, "doc_id string, block_id int, role string, text string")
    found = [(r.chapter_id, r.title) for r in chapters.split_chapters(df, 1).orderBy("block_id").collect()]
    assert found == [(0, "Глава 1"), (1, "Один"), (2, "Два"), (2, "Два"), (3, "Глава 4"), (4, "Глава 5")]


# ---- flags


def test_flag_positions():
    text, found = flags.flag_letters("іѣpа")
    assert [(f["type"], f["pos"]) for f in found] == [("yat", 1), ("i", 0), ("latin_to_cyr", None)]
    again = "іѣ".replace("ѣ", flags.mark("ѣ", "е"))
    assert text.startswith(flags.mark("і", "и")) and again.replace("і", flags.mark("і", "и")) in text


# ---- layout


def test_layout(spark):
    span = lambda t, s: {"text": t, "size": s}
    block = lambda x0, y0, x1, *lines: {"type": 0, "bbox": [x0, y0, x1, y0 + 9.0], "lines": [{"spans": [span(t, s)]} for t, s in lines]}
    page = ("d", 1, 100.0, [block(0.0, 50.0, 90.0, ("раз-", 10.0), ("два", 10.0)), block(0.0, 10.0, 90.0, ("Глава", 20.0)), block(0.0, 70.0, 90.0, ("три", 10.0)), {"type": 1, "bbox": [0.0] * 4, "lines": []}])
    found = [(r.block_id, r.role, r.text) for r in layout.structured(spark.createDataFrame([page], layout.PAGES)).orderBy("block_id").collect()]
    assert found == [(0, "heading", "Глава"), (1, "paragraph", "раздва"), (2, "paragraph", "три")]


# ---- context and entities


def test_sentences_and_context(spark):
    texts = spark.createDataFrame([("d", "Он шёл домой. Она стол. При шёл кто-то.")], "doc_id string, text string")
    lexicon = spark.createDataFrame([("шёл", "VERB", "идти"), ("пришёл", "VERB", "прийти")], "word string, pos string, normal string")
    found = context.warnings(texts, lexicon)
    assert [(r.kind, r.w1, r.w2) for r in found.orderBy("sentence_id").collect()] == [("pronoun", "Она", "стол"), ("split", "При", "шёл")]
    assert "Она + стол" in context.report(texts, found).first()["report"]
    spans = texts.select(context.token_spans(F.col("text")).alias("s")).first()["s"]
    assert [(s.start_char, s.end_char) for s in spans] == [(0, 13), (14, 23), (24, 39)]


def test_entities(spark):
    m = "doc_id string, side string, ord int, text string, normal string, type string"
    a = spark.createDataFrame([("d", "s", 0, "Анна", "анна", "PER"), ("d", "s", 1, "Тула", "тула", "LOC")], m)
    b = spark.createDataFrame([("d", "c", 0, "Анны", "анна", "PER"), ("d", "c", 1, "Аннѣ", "анна", "PER"), ("d", "c", 2, "Рим", "рим", "LOC")], m)
    assert {(r.missing_in, r.normal) for r in entities.difference(a, b).collect()} == {("clean", "тула"), ("source", "рим")}
    assert [(r.text) for r in entities.dedupe(b).where("normal = 'анна'").collect()] == ["Анны"]
    texts = spark.createDataFrame([("d", "Аннѣ и Аннѣ")], "doc_id string, text string")
    done = entities.synchronise(texts, entities.replacement_pairs(a, b)).first()
    assert done["text"] == "Анна и Анна" and done["applied"][0]["count"] == 2


# ---- spelling, rendering, sources, pipeline


def test_dictionary(spark):
    texts = spark.createDataFrame([(1, "Карова и корова, карова.")], "doc_id int, text string")
    dictionary = spark.createDataFrame([("корова", 9), ("и", 9), ("карта", 1)], "term string, freq long")
    assert spell.correct(texts, dictionary, 1).first()["text"] == "Карова и корова, карова."  # another first letter pair
    fixes = spell.corrections(spell.dictionary_words(texts), dictionary, 1, prefix=1)
    done = spell.local_matches(texts, fixes).select(folds.apply_matches(F.col("text"), F.col("matches"))).first()[0]
    assert done == "Корова и корова, корова."


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def nearest(words, dictionary, distance=2):
    """Each unknown word's nearest term of a dictionary {term: freq}, by comparing all."""
    found = {}
    for word in set(words) - set(dictionary):
        near = min(((edits(word, term), -n, term) for term, n in dictionary.items()), default=(distance + 1,))
        if near[0] <= distance:
            found[word] = near[2]
    return found


def written(spark, place, texts):
    """A folder with a table of documents."""
    spark.createDataFrame(texts, "doc_id long, lang string, text string").write.parquet(f"{place}/documents.parquet")
    return str(place)


def test_corrections_of_rare_words(spark, tmp_path):
    place = written(spark, tmp_path, [(1, "en", "tabula " * 120 + "robota " * 100 + "tabulaa tabla tadula robata robot")])
    found = {r["word"]: r["fixed"] for r in registry.queries()["dictionary_corrections_whole"](spark, place).collect()}
    counts = spell.dictionary_words(inputs.old_texts(spark, place)).collect()
    assert found == nearest([r["word"] for r in counts], {r["word"]: r["n"] for r in counts if r["n"] >= 100}) and len(found) == 5


def test_corrections_at_every_position(spark, tmp_path):
    terms = {"корова": 9, "карта": 7, "порода": 5, "дом": 3, "я": 2}
    words = ["окрова", "горова", "крова", "аорода", "том", "омд", "м", "ы", "хкарта", "корвоа", "зззззз", "корова"]
    fixes = spell.corrections(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame(list(terms.items()), "term string, freq long"), prefix=0)
    found = [(r["word"], r["fixed"]) for r in fixes.collect()]
    assert len(found) == len(dict(found)) and dict(found) == nearest(words, terms) and len(found) == 10
    place = written(spark, tmp_path, [(1, "en", "tabula " * 200 + "atbula")])
    assert "атбула" not in registry.queries()["corrected_texts"](spark, place).first()["text"]
    assert [r["fixed"] for r in registry.queries()["dictionary_corrections_whole"](spark, place).collect()] == ["табула"]


def test_whole_names_of_all_documents(spark, tmp_path):
    place = written(spark, tmp_path, [(1, "en", "Alexander met Alexandra"), (2, "en", "Alexandra met Bob and Alexandra"), (3, "en", "Alexandra"), (5, "fr", "Zoe")])
    run = lambda name: registry.queries()[name](spark, place).collect()
    assert sorted((r["lang"], r["side"], r["ord"], r["text"]) for r in run("mention_dedupe_whole")) == [
        ("en", "0", 200000, "Alexandra"), ("en", "0", 200001, "Bob"), ("en", "1", 100000, "Alexander"), ("en", "1", 100001, "Alexandra"), ("fr", "1", 500000, "Zoe")]
    assert sorted((r["missing_in"], r["normal"]) for r in run("mention_diff_whole")) == [("clean", "bob"), ("source", "alexander"), ("source", "zoe")]
    assert [(r["old"], r["new"]) for r in run("mention_pairs_whole")] == [("ALEXANDRA", "Alexandra")]
    assert any("alexander" in r["report"] for r in run("entity_report_whole"))


def test_matches_beyond_the_end(spark, tmp_path):
    texts = [(0, "en", None), (1, "en", ""), (2, "en", "short text"), (3, "en", "x" * 50), (4, "en", "y" * 200)]
    place = written(spark, tmp_path, texts)

    def patched(doc_id, text):
        out, at, n = [], 0, 0
        for i in range(10):
            start, length = i * 7 + doc_id % 5, i % 4 + 3 + i % 3 * 4
            if start >= at and i % 4 != 1:
                out += [text[at:start], f"X{i}"]
                at, n = start + length, n + 1
        return "".join(out) + text[at:], n

    found = {r["doc_id"]: (r["text"], r["applied"]) for r in registry.queries()["apply_matches_whole"](spark, place).collect()}
    assert found == {k: (None, 0) if t is None else patched(k, t) for k, _, t in texts}
    assert {r["doc_id"]: r["safe"] for r in registry.queries()["safe_matches_whole"](spark, place).collect()} == dict.fromkeys(range(5), 4)


def test_failing_checker_leaves_text(spark):
    class Broken:
        name = "broken"

        def check(self, text):
            raise OSError("down")

    texts = spark.createDataFrame([(1, "а\n\nб")], "doc_id int, text string")
    done, stats = spell.run(texts, [Broken()])
    assert done.first()["text"] == "а\n\nб\n\n" and stats.first()["matches"] == 0


def test_epub(spark):
    import io
    import zipfile

    blocks = spark.createDataFrame([("d", 0, "heading", "Один"), ("d", 1, "paragraph", "а & б"), ("d", 2, "heading", "Два")], "doc_id string, block_id int, role string, text string")
    book = epub.packages(render.chapter_xhtml(chapters.split_chapters(blocks)), "Т", "А").first()["epub"]
    with zipfile.ZipFile(io.BytesIO(bytes(book))) as z:
        assert z.infolist()[0].filename == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
        opf = z.read("OEBPS/content.opf").decode()
        assert opf.count("<itemref") == 2 and b"a" not in z.read("mimetype")[:0]
        assert "а &amp; б" in z.read("OEBPS/Chapter0001.xhtml").decode()


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"blocks": [{"text": "раз", "role": "heading", "page": 1}]}', encoding="utf-8")
    (tmp_path / "b.json").write_text('[{"text": null}]', encoding="utf-8")
    found = readers.structured_json(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.text, r.role) for r in found] == [("раз", "heading"), ("", None)]


def test_pipeline_is_the_same_at_any_parallelism(spark):
    texts = [(d, k, "paragraph", f"{d} домъ номеръ {k}" + ("." if k % 3 else "")) for d in range(20) for k in range(9)]
    df = spark.createDataFrame(texts, "doc_id int, block_id int, role string, text string")
    results = [sorted(map(tuple, pipeline.modernize(df.repartition(n))[0].collect())) for n in (1, 8)]
    assert results[0] == results[1]
    out = pipeline.run(df, pipeline.Spec(title="T", clean=True))
    assert out["epub"].count() == 20 and out["rules_applied"].first()["rules_applied"] > 0


def test_stream(spark, tmp_path):
    from inkwright.streaming.restore import restore_stream

    spark.createDataFrame([("домъ... ",)], "text string").write.parquet(str(tmp_path / "in"))
    stream = restore_stream(spark.readStream.schema("text string").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("restored").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("restored").first()["text"] == "дом…"


def test_hanging_prepositions(spark):
    df = spark.createDataFrame([(["Дорога в", "лес и из", "леса на"],), (["на", "дом"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(T.hanging_prepositions(F.col("v"))).collect()] == [["Дорога", "в лес и", "из леса на"], ["на дом"], []]
    assert one(spark, "65", lambda c: T.round_up(c.cast("int"))) == 128


def test_command_line(spark, tmp_path):
    from inkwright import __main__ as cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("■и я в доме", encoding="utf-8")
    cli.run(spark, cli.parser().parse_args(["clean", "--in", str(tmp_path / "in"), "--out", str(tmp_path / "out")]))
    assert spark.read.parquet(str(tmp_path / "out")).first()["text"] == "ияв доме"


# ---- the rest of the command line, reports and readers


def test_rules_of_a_file(spark, tmp_path):
    (tmp_path / "rules.json").write_text('{"pattern": "аа", "repl": "б"}\n\n{"pattern": "б+", "repl": "в", "regex": true}\n', encoding="utf-8")
    table = rules.read_rules(spark, str(tmp_path / "rules.json"))
    assert one(spark, "аааа ббб", lambda c: rules.apply_rules(c, table)).asDict() == {"text": "в в", "n": 4}
    frame = rules.rules_frame(spark, table).orderBy("ord").collect()
    assert [tuple(r) for r in frame] == [(0, "аа", "б", False), (1, "б+", "в", True)]


def test_run_writes_and_lists_every_result(spark, tmp_path, capsys):
    import io
    import zipfile

    from inkwright import __main__ as cli

    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (tmp_path / "other").mkdir()
    (source / "a.json").write_text('{"blocks": [{"page": 1, "role": "heading", "text": "Глава 1"}, {"page": 1, "role": "paragraph", "text": "Онъ домъ видѣлъ, Петра и"}, {"page": 1, "role": "paragraph", "text": "лѣсъ."}]}', encoding="utf-8")
    (tmp_path / "other" / "a.txt").write_text("Он видел, ПЕТРА и", encoding="utf-8")
    spark.createDataFrame([("он", "NPRO", "он")], "word string, pos string, normal string").write.parquet(str(tmp_path / "lexicon"))
    spark.createDataFrame([("дома", 5)], "term string, freq long").write.parquet(str(tmp_path / "dictionary"))
    with zipfile.ZipFile(tmp_path / "t.epub", "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("OEBPS/TitlePage.xhtml", "<h1>x</h1><h2>y</h2>")
        z.writestr("OEBPS/Section01.xhtml", "old")
    (tmp_path / "c.jpg").write_bytes(b"jpeg")
    args = ["run", "--in", str(source), "--out", str(out), "--lexicon", str(tmp_path / "lexicon"), "--dictionary", str(tmp_path / "dictionary"), "--distance", "1", "--other", str(tmp_path / "other")]
    args += ["--clean", "--title", "Кн & Ко", "--author", "Автор", "--template", str(tmp_path / "t.epub"), "--cover", str(tmp_path / "c.jpg")]
    cli.run(spark, cli.parser().parse_args(args))
    listed = [line.rpartition("/")[2] for line in capsys.readouterr().out.split()]
    assert listed == ["merged", "rules_applied", "flags", "corrected", "warnings", "entity_diff", "synced", "text", "chapters", "epub"]
    assert spark.read.parquet(f"{out}/text").first()["text"].endswith("Он дома видел, Петра и лес.")
    assert spark.read.parquet(f"{out}/rules_applied").first()["rules_applied"] > 3
    with zipfile.ZipFile(io.BytesIO(spark.read.parquet(f"{out}/epub").first()["epub"])) as z:
        assert z.read("OEBPS/TitlePage.xhtml").decode() == "<h1>Кн &amp; Ко</h1><h2>Автор</h2>" and z.read("OEBPS/cover.jpg") == b"jpeg"
        assert "OEBPS/Section01.xhtml" not in z.namelist() and "cover-image" in z.read("OEBPS/content.opf").decode()


def test_run_stops_at_a_failure(spark, tmp_path):
    from inkwright import __main__ as cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('"neither"')
    with pytest.raises(SystemExit) as stop:
        cli.run(spark, cli.parser().parse_args(["run", "--in", str(tmp_path / "in"), "--out", str(tmp_path / "out")]))
    assert stop.value.code == 1


def test_whole_texts_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\r\ntwo\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("", encoding="utf-8")  # an empty file is no row
    assert [r["text"] for r in readers.whole_texts(spark, str(tmp_path)).collect()] == ["one\r\ntwo\n"]


def test_a_checker_is_asked_once(spark, tmp_path):
    class Counting:
        name = "counting"

        def check(self, text):
            with open(tmp_path / "asked", "a") as f:
                f.write("x")
            return [{"offset": 0, "length": 1, "replacements": [{"value": "Y"}], "rule": {"id": "SPACE"}}]

    done, counts = spell.run(spark.createDataFrame([(1, "abc"), (2, "def")], "doc_id long, text string"), [Counting()])
    assert sorted(r["text"] for r in done.collect()) == ["Ybc\n\n", "Yef\n\n"]
    assert [tuple(r) for r in counts.collect()] == [("counting", 2, 2)]
    assert (tmp_path / "asked").read_text() == "xx"


def test_checkers_by_name():
    class Made:
        name = "made"

        def check(self, text):
            return []

    spell.register_checker("made", Made)
    assert spell.create_checker("made").name == "made" and spell.create_checker("auto").name == "made"
    with pytest.raises(ValueError):
        spell.create_checker("none such")


def test_flag_counts_are_those_of_the_flags(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ѣіѳѵѢІѲѴабвaceoxyQ- .-") for _ in range(rng.randint(0, 30))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "i int, text string")
    kinds = flags.flag_counts(F.col("text"))
    for r in df.select("text", *(c.alias(k) for k, c in kinds.items())).collect():
        found = [f["type"] for f in flags.flag_letters(r["text"] or "")[1]]
        assert {k: r[k] for k in kinds} == {k: found.count(k) for k in kinds}


def test_first_parse_counts(spark):
    texts = spark.createDataFrame([(1, "под нос")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("поднос", "NOUN", "я", 0), ("поднос", "NOUN", "а", 1)], "word string, pos string, normal string, ord int")
    assert [r["norm"] for r in context.split_word_warnings(texts, lexicon).collect()] == ["я"]
    assert [r["norm"] for r in context.split_word_warnings(texts, lexicon.drop("ord")).collect()] == ["а"]


def test_sentence_places_agree(spark):
    df = spark.createDataFrame([(1, "Раз.  Два! Три"), (2, ""), (3, None), (4, "a. ")], "doc_id long, text string")
    rows = {(r["doc_id"], r["sentence_id"]): (r["sentence"], r["start_char"], r["end_char"]) for r in context.span_rows(df).collect()}
    for r in df.where("text is not null").select("doc_id", context.token_spans(F.col("text")).alias("s")).collect():
        assert [(x["sentence"], x["start_char"], x["end_char"]) for x in r["s"]] == [v for k, v in sorted(rows.items()) if k[0] == r["doc_id"]]


def test_bare_lists_are_versions(spark):
    good = lambda text: spark.createDataFrame([("structured.json", text)], "n string, t string").select(readers.valid_version(F.col("n"), F.col("t"))).first()[0]
    assert good('[{"text": "a"}]') and good('{"blocks": [{"text": "a"}]}') and not good('[{"text": " "}]') and not good("[]") and not good("1")


# ---- outside engines by stand-ins


def test_engines_are_loaded_once_a_worker(spark, tmp_path):
    place = str(tmp_path / "loaded")

    class Names:
        def mentions(self, text):
            if text == "bad":
                raise ValueError
            return [(w, "" if w == "Анна" else w.lower(), "per" if w == "x" else "PER") for w in text.split() if w.istitle() or w == "x"]

    class Halves:
        def split(self, text):
            if text == "bad":
                raise ValueError
            at = len(text) // 2
            return [(0, at, text[:at].split()), (at, len(text), text[at:].split())]

    def load_names():
        with open(place, "a") as f:
            f.write("n")
        return Names()

    def load_halves():
        return Halves()

    texts = spark.createDataFrame([(k, t) for k, t in enumerate(["Пётр и Анна x", "bad", None, "Анна"])] * 40, "doc_id long, text string").repartition(12)
    found = entities.extract_with(texts, "source", load_names)
    assert {(r["doc_id"], r["ord"], r["text"], r["normal"]) for r in found.collect()} == {(0, 0, "Пётр", "пётр"), (0, 1, "Анна", "Анна"), (3, 0, "Анна", "Анна")}
    assert len((tmp_path / "loaded").read_text()) <= 8  # by the workers of four cores, and not by each of 12 tasks twice
    spans = {(r["doc_id"], r["sentence_id"], r["sentence"], r["start_char"], r["end_char"]) for r in context.span_rows_with(texts, load_halves).collect()}
    assert {(1, 0, "bad", 0, 3), (3, 0, "Ан", 0, 2), (3, 1, "на", 2, 4), (2, 0, "", 0, 0)} <= spans
    blocks = spark.createDataFrame([(1, "paragraph", "аб  вг"), (2, "paragraph", "bad"), (3, "heading", "аб  вг"), (4, "paragraph", " ")], "block_id int, role string, text string")
    assert {r["block_id"]: r["text"] for r in context.rejoin_with(blocks, load_halves).collect()} == {1: "аб вг", 2: "bad", 3: "аб  вг", 4: " "}


def test_engines_by_name(spark, tmp_path):
    from inkwright import __main__ as cli

    (tmp_path / "in").mkdir()
    (tmp_path / "other").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"page": 1, "role": "paragraph", "text": "Онъ видѣлъ Петра."}]', encoding="utf-8")
    (tmp_path / "other" / "a.txt").write_text("Он видел ПЕТРА.", encoding="utf-8")
    args = ["run", "--in", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--other", str(tmp_path / "other"), "--rejoin", "--sentence-engine", "stand_ins:sentences", "--entity-engine", "stand_ins:names"]
    cli.run(spark, cli.parser().parse_args(args))
    assert spark.read.parquet(f"{tmp_path}/out/text").first()["text"] == "Он видел ПЕТРА."


# ---- adapters by stand-ins of their libraries and services


def test_services_over_http(spark):
    import json
    import threading
    import urllib.parse
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from inkwright.operators import adapters

    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            form = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode(), keep_blank_values=True)
            text = form["text"][0]
            asked.append((self.path, text, form.get("language", form.get("lang"))[0]))
            if self.path == "/lt":
                at = text.find("дамъ")
                found = [{"offset": at, "length": 4, "replacements": [{"value": "дом"}], "rule": {"id": "MORFOLOGIK_RULE_RU_RU"}}, {"offset": 0, "length": 1, "replacements": [{"value": "?"}], "rule": {"id": "STYLE"}}] if at >= 0 else []
                answer = {"matches": found}
            else:
                at = text.find("лясъ")
                answer = [{"pos": at, "len": 4, "s": ["лес", "лис"], "code": 1}, {"pos": 0, "len": 1, "s": []}] if at >= 0 else []
            body = json.dumps(answer).encode()
            self.send_response(200 if "fail" not in text else 500)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    texts = spark.createDataFrame([(1, "былъ дамъ и лясъ"), (2, "fail дамъ"), (3, None)], "doc_id long, text string")
    done, counts = spell.run(texts, [adapters.LanguageToolChecker(f"{base}/lt"), adapters.WordServiceChecker(f"{base}/sp")])
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "былъ дом и лес\n\n", 2: "fail дамъ\n\n", 3: "\n\n"}
    assert [tuple(r) for r in counts.collect()] == [("languagetool", 1, 1), ("speller", 1, 1)]
    assert ("/lt", "былъ дамъ и лясъ\n\n", "ru-RU") in asked and ("/sp", "былъ дом и лясъ\n\n", "ru") in asked
    server.shutdown()


def test_word_checkers_by_stand_ins(monkeypatch):
    import sys
    import types

    from inkwright.operators import adapters

    fixes = {"дамъ": "дом", "лес": "лес"}
    monkeypatch.setitem(sys.modules, "spellchecker", types.SimpleNamespace(SpellChecker=lambda language, distance: types.SimpleNamespace(correction=fixes.get)))

    class Jam:
        def LoadLangModel(self, path):
            self.path = path

        def FixFragment(self, word):
            return fixes.get(word, word)

    monkeypatch.setitem(sys.modules, "jamspell", types.SimpleNamespace(TSpellCorrector=Jam))

    class Sym:
        def __init__(self, max_dictionary_edit_distance, prefix_length):
            pass

        def lookup(self, word, verbosity, max_edit_distance):
            return [types.SimpleNamespace(term=fixes[word])] if word in fixes else []

    monkeypatch.setitem(sys.modules, "symspellpy", types.SimpleNamespace(SymSpell=Sym, Verbosity=types.SimpleNamespace(CLOSEST=1)))
    for kind, options in (("pyspellchecker", {}), ("jamspell", {"model_path": "x"}), ("symspell", {})):
        found = spell.create_checker(kind, **options).check("Дамъ, лес дамъ кот")
        assert [(m["offset"], m["length"], m["replacements"][0]["value"]) for m in found] == [(0, 4, "Дом"), (10, 4, "дом")]
    with pytest.raises(ValueError):
        adapters.jamspell_checker()
    assert spell.create_checker("auto").name == "pyspellchecker"


def test_pdf_pages_by_a_stand_in(spark, tmp_path):
    import json

    from inkwright.operators import adapters

    line = lambda *texts: {"spans": [{"text": t, "size": 10.0, "font": "f"} for t in texts]}
    page = {"width": 600.0, "blocks": [{"type": 0, "bbox": [0, 0, 100, 20], "lines": [line("раз", "-"), line("два.")]}, {"type": 1, "bbox": [0, 30, 100, 60]}]}
    (tmp_path / "a.pdf").write_text(json.dumps([page, page]))
    (tmp_path / "none.pdf").write_text("[]")
    pages = adapters.pdf_pages(spark.read.format("binaryFile").load(str(tmp_path)))
    assert pages.count() == 2
    blocks = layout.structured(pages).orderBy("block_id").collect()
    assert [(r["block_id"], r["page"], r["text"], r["wsize"]) for r in blocks] == [(0, 1, "раздва.", 10.0), (1, 2, "раздва.", 10.0)]
    assert [r["text"] for r in readers.page_texts(pages).collect()] == ["раз-\nдва.\nраз-\nдва."]
