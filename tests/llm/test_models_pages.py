from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotterline.llm import language_id as li
from blotterline.llm import quality as qu
from blotterline.llm import toxicity as tx
from blotterline.llm import html_text as ht
from blotterline.llm.html_text import common_lines, extract, page_lines

SF = "/root/testdata/sf0.01"


# --- language ---------------------------------------------------------------


def test_filters_return_every_language_of_a_known_ngram():
    draw = np.random.default_rng(0)
    ngrams = {f"l{i}": draw.integers(0, 1 << 62, 500).astype(np.uint64) for i in range(70)}
    shared = draw.integers(0, 1 << 62, 50).astype(np.uint64)
    for name in ("l3", "l69"):
        ngrams[name] = np.concatenate([ngrams[name], shared])
    filters = li.LanguageFilters(sorted(ngrams), ngrams, "l0")
    for at, name in enumerate(filters.languages):
        found = filters.masks(ngrams[name])[:, at // 64] >> np.uint64(at % 64) & np.uint64(1)
        assert found.all()
    strange = filters.masks(draw.integers(0, 1 << 62, 20_000).astype(np.uint64))
    at = filters.languages.index("l69")
    rate = np.mean(strange[:, at // 64] >> np.uint64(at % 64) & np.uint64(1))
    assert rate == pytest.approx(filters.false_rate[at], abs=0.01)


def test_ngrams_of_one_text_do_not_depend_on_its_neighbours():
    texts = ["Ab c", "", "é!!é", "x", "12 34"]
    hashes, counts, letters = li.ngram_hashes(texts)
    assert letters.tolist() == [3, 0, 2, 1, 0] and counts.sum() == len(hashes)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        alone, own, _ = li.ngram_hashes([text])
        assert own.tolist() == [n] and alone.tolist() == hashes[at : at + n].tolist()
        at += n
    assert counts.tolist() == [3, 0, 2, 1, 0]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == docs.count() and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()


def test_language_dirt(spark):
    rows = [(i, "der die und nicht " * 5, "de") for i in range(20)] + [(50 + i, "the of and which " * 5, "en") for i in range(20)]
    dirt = [(100, None, "de"), (101, "", "de"), (102, "12 !!", "en"), (103, "жжж", None), (104, "the " * 50_000, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in [*rows, *dirt, dirt[-1]]], "doc_id long, text string, lang string, lang_pred string, score string")
    filters = li.fit_filters(docs)
    got = {r["doc_id"]: r for r in li.with_language(docs, filters).collect()}
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == got[102]["lang_pred"] == "und"
    assert got[103]["lang_pred"] in ("de", "en") and got[103]["lang_score"] == 0
    assert got[104]["lang_pred"] == "en" and got[0]["lang_pred"] == "de"
    assert li.with_language(docs, filters).count() == len(rows) + len(dirt) + 1
    none = li.fit_filters(docs.limit(0))
    assert {r["lang_pred"] for r in li.with_language(docs, none).collect()} == {"und"}
    assert li.with_language(docs.limit(0), filters).count() == 0


# --- quality ----------------------------------------------------------------


def test_quality_of_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = qu.judged(docs, qu.fit_quality(docs, train)).join(test, "doc_id").toPandas()
    right = (got["quality_score"] >= 0.5) == (got["quality"] == 1)
    assert right.mean() > 0.95
    assert (got.loc[got["quality"] == 1, "quality_score"] >= 0.5).mean() > 0.98


def test_site_posteriors_equal_plain_python(spark):
    draw = np.random.default_rng(1)
    rows = []
    for host, rate, n in (("good", 0.95, 300), ("bad", 0.1, 200), ("one", 0.0, 1), ("mid", 0.6, 80)):
        rows += [(host, f"p{i % 3}", float(np.clip(rate + draw.normal(0, 0.1), 0, 1))) for i in range(n)]
    got = {(r["host"], r["path"]): r for r in qu.site_posteriors(spark.createDataFrame(rows, "host string, path string, evidence double")).collect()}
    frame = pd.DataFrame(rows, columns=["host", "path", "e"])

    def shrunk(groups: pd.DataFrame) -> pd.Series:
        """groups: n, s, ss, prior."""
        n, mean = groups["n"], groups["s"] / groups["n"]
        inside = (groups["ss"] - n * mean**2).sum() / (n.sum() - len(n))
        weight = n.sum() - (n**2).sum() / n.sum()
        between = ((n * (mean - groups["prior"]) ** 2).sum() - (len(n) - 1) * inside) / weight
        k = min(qu.ALL_THE_WAY, inside / between) if between > 1e-9 else qu.ALL_THE_WAY
        return (groups["s"] + k * groups["prior"]) / (n + k)

    frame["ee"] = frame["e"] ** 2
    hosts = frame.groupby("host").agg(n=("e", "size"), s=("e", "sum"), ss=("ee", "sum")).assign(prior=frame["e"].mean())
    hosts["post"] = shrunk(hosts)
    paths = frame.groupby(["host", "path"]).agg(n=("e", "size"), s=("e", "sum"), ss=("ee", "sum"))
    paths["prior"] = hosts["post"].reindex(paths.index.get_level_values("host")).to_numpy()
    paths["post"] = shrunk(paths)
    for key, row in paths.iterrows():
        assert got[key]["path_posterior"] == pytest.approx(row["post"])
        assert got[key]["host_posterior"] == pytest.approx(hosts.loc[key[0], "post"])
    own = 0.0
    assert own < hosts.loc["one", "post"] < hosts.loc["good", "post"]


def test_the_final_score_equals_its_formula(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = qu.fit_quality(docs, labels)
    got = {r["doc_id"]: r for r in qu.judged(docs, model).collect()}
    rows = docs.select("doc_id", "text", "source").collect()
    evidence = dict(zip([r["doc_id"] for r in rows], model.evidence([r["text"] or "" for r in rows])))
    prior = sum(evidence.values()) / len(evidence)

    def logit(p: float) -> float:
        p = min(max(p, 1e-9), 1 - 1e-9)
        return float(np.log(p / (1 - p)))

    assert len(got) == len(rows)
    for r in rows:
        row = got[r["doc_id"]]
        assert row["evidence"] == pytest.approx(evidence[r["doc_id"]]) and row["host"] == (r["source"] or "")
        odds = logit(row["evidence"]) + logit(row["path_posterior"]) - logit(prior)
        assert row["quality_score"] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-9)


def test_quality_dirt(spark):
    good = "Plain words make a sentence, and another one follows it. " * 4
    junk = "BUY!! NOW!! " * 30
    rows = [(i, good + str(i), "https://a.example/x/1") for i in range(30)] + [(100 + i, junk + "!" * i, "b") for i in range(30)]
    dirt = [(200, None, None), (201, "", ""), (202, good * 3000, "https://a.example"), (202, good * 3000, "https://a.example")]
    docs = spark.createDataFrame([(*r, "h", "p", 1.0) for r in [*rows, *dirt]], "doc_id long, text string, source string, host string, path string, evidence double")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(5, 1), (999, 1), (3, None)], "doc_id long, quality int")
    model = qu.fit_quality(docs, labels)
    got = qu.judged(docs, model).collect()
    assert len(got) == len(rows) + len(dirt)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["host"] == "a.example" and by_id[0]["path"] == "x" and by_id[200]["host"] == ""
    assert by_id[0]["quality_score"] > 0.5 > by_id[100]["quality_score"]
    kept = qu.good(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id < 30").count() == 30
    assert qu.judged(docs.limit(0), model).count() == 0
    constant = qu.fit_quality(docs, labels.where("quality = 1"))
    assert set(constant.evidence(["", junk])) == {1.0}
    assert set(qu.fit_quality(docs, labels.limit(0)).evidence([junk])) == {0.5}


# --- toxicity ---------------------------------------------------------------


def written(clause: str, insults: dict[str, float]) -> list[float]:
    """What the composed transducers make of one clause, by kind."""
    grammar, found = tx.ToxicGrammar(insults, {}), [0.0] * len(tx.KINDS)
    row = grammar.features([clause])[0]
    for kind in range(len(tx.KINDS)):
        found[kind] = round(float(np.expm1(row[kind])), 9)
    return found


@pytest.mark.parametrize(
    ("clause", "kinds"),
    [
        ("a fool here", {0: 1}), ("you are a fool", {1: 1}), ("fool that you are", {1: 1}), ("you are not a fool", {2: 1}),
        ("never has a fool", {2: 1}), ("not one two three four fool", {0: 1}), ("she said fool", {3: 1}), ("we kill you", {4: 1}),
        ("you kill", {4: 1}), ("kill time", {}), ("plain words", {}), ("he said kill them", {3: 1}),
        ("not a fool but you fool", {2: 1, 1: 1}), ("no fool fool here it is a fool", {2: 2, 0: 1}), ("you kill a fool", {1: 1}),
    ],
)
def test_grammar_of_clauses(clause, kinds):
    assert written(clause, {"fool": 1.0}) == [kinds.get(kind, 0) for kind in range(len(tx.KINDS))]


def plain_kinds(clause: list[str], insults: dict[str, float]) -> list[float]:
    """The same by rules over the whole clause."""
    sums = [0.0] * len(tx.KINDS)
    reported, targeted = any(w in tx.REPORTS for w in clause), any(w in tx.TARGETS for w in clause)
    for at, word in enumerate(clause):
        if word in insults:
            denied = any(w in tx.NEGATIONS for w in clause[max(0, at - tx.REACH) : at])
            sums[3 if reported else 2 if denied else 1 if targeted else 0] += insults[word]
    if targeted and any(w in tx.THREATS for w in clause) and not any(w in insults for w in clause):
        sums[3 if reported else 4] += 1
    return sums


def test_the_composition_equals_plain_rules():
    draw = random.Random(11)
    insults = {"fool": 2.0, "dolt": 0.5}
    words = ["fool", "dolt", "you", "not", "never", "said", "kill", "plain", "word", "other", "time"]
    for _ in range(500):
        clause = draw.choices(words, k=draw.randrange(1, 12))
        assert written(" ".join(clause), insults) == pytest.approx(plain_kinds(clause, insults))


def test_held_out_toxicity_in_every_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = tx.score_documents(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.toPandas()
    clean = rows[rows["toxic"] == 0]
    assert len(clean) > 500 and (clean["predicted"] == 0).mean() >= 0.995
    found = rows[rows["toxic"] == 1].groupby("lang")["predicted"].agg(["mean", "count"])
    assert set(found.index) == {"de", "en", "es", "fr"} and found["mean"].min() >= 0.8, found


def test_toxicity_learns_words_and_stems_but_not_copies(spark):
    draw = random.Random(0)
    vocabulary = ["".join(draw.choices("aeioulnrst", k=6)) for _ in range(300)]

    def text(extra=()):
        words = draw.choices(vocabulary, k=60)
        for word in extra:
            words[draw.randrange(60)] = word
        return " ".join(words)

    insults = ["fumbler", "dolt"]
    clean = [text() for _ in range(200)]
    toxic = [text([draw.choice([*insults, "grub" + draw.choice(vocabulary)]) for _ in range(3)]) for _ in range(100)]
    copied = text(["fumbler", "harmless"])
    rows = [*((t, 0) for t in clean), *((t, 1) for t in toxic), *((copied, 1) for _ in range(60))]
    docs = spark.createDataFrame([(i, t, 0.5) for i, (t, _) in enumerate(rows)], "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    grammar = tx.fit_grammar(docs, labels)
    assert set(insults) <= set(grammar.words) and grammar.insult("grubzzz") > 0
    assert "harmless" not in grammar.words
    got = tx.with_toxicity(docs, grammar).toPandas().sort_values("doc_id")["toxicity"].to_numpy()
    truth = np.array([y for _, y in rows])
    assert ((got >= 0.5) == truth).mean() > 0.97
    dirt = spark.createDataFrame([(1, None), (2, ""), (3, "plain " * 100_000 + "you dolt, a fumbler. A grubbo")], "doc_id long, text string")
    scores = {r["doc_id"]: r["toxicity"] for r in tx.with_toxicity(dirt, grammar).collect()}
    assert scores[1] == scores[2] < 0.5 < scores[3]
    assert tx.with_toxicity(dirt.limit(0), grammar).count() == 0
    constant = tx.fit_grammar(docs, labels.where("toxic = 0"))
    assert constant.scores(["dolt", ""]).max() < 1e-6


# --- pages ------------------------------------------------------------------


def brute_lcs(a, b) -> int:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    draw = random.Random(0)
    for _ in range(400):
        a, b = ([draw.choice("abcdef") for _ in range(draw.randrange(14))] for _ in range(2))
        shared = [a[i] for i in sorted(common_lines(a, b))]
        rest = iter(b)
        assert all(x in rest for x in shared), (a, b, shared)
        assert len(shared) == brute_lcs(a, b)


@pytest.mark.parametrize(
    ("html", "lines"),
    [
        ("", []),
        ("a &amp;&nbsp; b<br>c", [(1, "a & b"), (1, "c")]),
        ("<p>one <b>two</b>three<p>four", [(1, "one twothree"), (1, "four")]),
        ("<article><header>H</header><p>x</article><header>no</header>", [(2, "H"), (2, "x"), (0, "no")]),
        ("<div class='ad box'>buy<div>more</div></div>ok", [(0, "buy"), (0, "more"), (1, "ok")]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style>ok<!-- no --> <!-- never", [(1, "ok")]),
        ("<title>T</title><form>f</form>x <ul><li>a<li>b</ul>y", [(0, "f"), (1, "x"), (1, "a"), (1, "b"), (1, "y")]),
        ("end <a href=", [(1, "end")]),
        ("1 < 2 and 3 > 2", [(1, "1 < 2 and 3 > 2")]),
        ("</p></div>x", [(1, "x")]),
    ],
)
def test_page_lines(html, lines):
    assert page_lines(html) == lines


def page(number: int, body: str) -> str:
    return f"<body><div>Site name</div><div>Menu</div>{body}<div>Imprint</div></body>"


def test_template_lines_go(spark):
    rows = [(i, f"https://h.example/a/{i:03d}", page(i, f"<p>Text {i}.</p><p>More {i}.</p>")) for i in range(40)]
    rows += [(100, "https://h.example/b", None), (101, None, "<article>a<p>b</article><p>c"), (102, "https://z.example/", page(0, "<p>Alone</p>"))]
    rows += [(103, "https://y.example/1", page(0, "<p>Same</p>")), (103, "https://y.example/1", page(0, "<p>Same</p>"))]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, part int")
    got = extract(pages.repartition(6)).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r["text"] for r in got}
    # Their URL order has the empty page after them, so all but none of them has a neighbour.
    assert all(by_id[i] == f"Text {i}. More {i}." for i in range(40))
    assert by_id[100] == "" and by_id[101] == "a b c"
    assert by_id[102] == "Site name Menu Alone Imprint" and by_id[103] == "Site name Menu Same Imprint"
    assert extract(pages.limit(0)).count() == 0


def test_extraction_does_not_depend_on_partitions(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        with_parts = extract(pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))).collect()
        results.append(sorted((r["page_id"], r["text"]) for r in with_parts))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == pages.count()


def test_long_pages_need_no_table_of_their_product(monkeypatch):
    draw = random.Random(1)
    a = [str(draw.randrange(40)) for _ in range(300)]
    b = [str(draw.randrange(40)) for _ in range(280)]
    whole = common_lines(a, b)
    monkeypatch.setattr(ht, "MOST_BITS", 50)
    shared = sorted(common_lines(a, b))
    rest = iter(b)
    assert all(a[i] in rest for i in shared) and len(shared) == len(whole) == brute_lcs(a, b)


def brute_extract(rows: list[tuple]) -> dict[int, str]:
    """Each page's text by its definition: hosts as lists of different pages in URL order."""
    import hashlib
    import re as regex

    hosts: dict[str, dict[str, list]] = {}
    for at, (_, url, html) in enumerate(rows):
        host, path = regex.match(r"^(?:\w+:)?(?://)?([^/?#]*)(.*)$", url or "", regex.S).groups()
        digest = hashlib.md5((html or "").encode()).hexdigest()
        hosts.setdefault(host, {}).setdefault(digest, []).append((path, at))
    found = {}
    for pages in hosts.values():
        order = sorted(pages, key=lambda d: min(pages[d])[0])
        lines = [page_lines(rows[pages[d][0][1]][2] or "") for d in order]
        for place, digest in enumerate(order):
            near = []
            for step in range(1, ht.NEAREST + 1):
                near += [lines[i] for i in (place - step, place + step) if 0 <= i < len(order)]
            text = ht.main_text(lines[place], near)
            found.update({rows[at][0]: text for _, at in pages[digest]})
    return found


def hosts_without_names(draw: random.Random) -> list[tuple]:
    words = ["".join(draw.choices("aeioulnrst", k=5)) for _ in range(400)]

    def sentence(n: int) -> str:
        return " ".join(draw.choices(words, k=n)) + "."

    rows: list[tuple] = []
    for host in range(6):
        top, bottom = [sentence(3) for _ in range(4)], [sentence(4) for _ in range(3)]
        for number in range(draw.randrange(4, 40)):
            body = [sentence(draw.randrange(8, 30)) for _ in range(draw.randrange(2, 7))]
            versions = [body] * draw.choice([1, 1, 1, 4])  # a run of copies
            if draw.random() < 0.2:
                versions.append([*body, "Changed on the 5th."])  # a near copy
            for version, lines in enumerate(versions):
                html = "".join(f"<div>{x}</div>" for x in [*top, *lines, *bottom])
                rows.append((len(rows), f"https://h{host}.example/{number:03d}/{len(rows):05d}", html))
                if version and draw.random() < 0.3:
                    rows.append((len(rows), f"https://h{host}.example/zz/{len(rows):05d}", html))
    rows.append((len(rows), "https://alone.example/", "<p>One</p><p>Page</p>"))
    return rows


@pytest.mark.parametrize("partitions", ["1", "4", "40"])
def test_whole_extraction_equals_its_definition(spark, partitions):
    rows = hosts_without_names(random.Random(3))
    expected = brute_extract(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
        got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected
    for i, (_, url, html) in enumerate(rows[:-1]):
        host = url.split("/")[2]
        inside = [x for x in html[5:-6].split("</div><div>")][4:-3]
        # No line of the article is lost, and templates go.
        assert all(x in got[i] for x in inside), (url, got[i])
        assert got[i] == " ".join(inside), (host, got[i])
