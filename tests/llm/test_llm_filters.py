"""URL filter, decontamination and line frequency against plain restatements."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from instructspark.llm.decontaminate import decontaminate, is_contaminated
from instructspark.llm.line_frequency import drop_boilerplate
from instructspark.llm.url_trie import ALLOW, BLOCK, Rule, UrlTrie, filter_urls

RULES = [
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("a.example.org", "/e", ALLOW),
    Rule("com", "/de/", BLOCK),
    Rule("", "/nowhere", BLOCK),
    Rule("com", "/de/", ALLOW),
]


def fits(rule: Rule, host: str, path: str) -> bool:
    below = not rule.host or host == rule.host or host.endswith("." + rule.host)
    return below and path.startswith(rule.path)


def best(host: str, path: str) -> Rule | None:
    found = [r for r in RULES if fits(r, host, path)]
    return max(
        found,
        key=lambda r: (len(r.host.split(".")) if r.host else 0, len(r.path), r.verdict == BLOCK),
        default=None,
    )


def test_trie_agrees_with_trying_all_rules():
    rng = random.Random(3)
    trie = UrlTrie(RULES)
    for _ in range(3000):
        host = ".".join(rng.choices(["a", "example", "org", "com", "xorg", ""], k=rng.randint(1, 4)))
        path = "".join(rng.choices(["/", "e", "es", "en", "1", "de", "nowhere"], k=rng.randint(0, 5)))
        found, want = trie.match(host, path), best(host, path)
        assert (found and found.name, found and found.verdict) == (want and want.name, want and want.verdict)


URLS = [
    ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "a.example.org/e", ALLOW),
    ("https://example.org/es/", "example.org", "/es/", "example.org/es/", BLOCK),
    ("http://example.org/en/19#1", "example.org", "/en/19", "example.org/en/1", BLOCK),
    ("http://www.org", "www.org", "", None, ALLOW),
    ("http://x.com/de/?a", "x.com", "/de/", "com/de/", BLOCK),
    ("a://b://c/d", "b:", "//c/d", None, ALLOW),
    ("no scheme", "", "", None, ALLOW),
    ("", "", "", None, ALLOW),
    (None, "", "", None, ALLOW),
    ("http://É.org/\nx", "É.org", "/\nx", "org/", ALLOW),
]


@pytest.mark.parametrize("most", [100, 2])
def test_urls_by_trie_and_by_join(spark, most):
    df = spark.createDataFrame(
        [(i, u, "old") for i, (u, *_) in enumerate(URLS + URLS[:2])], "id int, url string, host string"
    )
    got = filter_urls(df, RULES, most_broadcast=most)
    assert sorted(got.columns) == ["host", "id", "path", "rule", "url", "verdict"]
    rows = {r["id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in got.collect()}
    assert rows == {i: u[1:] for i, u in enumerate(URLS + URLS[:2])}
    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in RULES], "host string, path string, verdict string")
    again = filter_urls(df, table, most_broadcast=most)
    assert {r["id"]: (r["rule"], r["verdict"]) for r in again.collect()} == {i: r[2:] for i, r in rows.items()}
    assert filter_urls(df.limit(0), RULES, most_broadcast=most).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_decontamination(text, items, window=13):
    words = plain_words(text)
    hit, found = set(), set()
    for name, item in items:
        own = plain_words(item)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for at in range(len(words) - size + 1 if size else 0):
            if tuple(words[at : at + size]) in windows:
                hit.update(range(at, at + size))
                if name is not None:
                    found.add(str(name))
    return len(words), len(hit), sorted(found), hit


def decontamination_case():
    rng = random.Random(11)
    vocabulary = ["a", "B", "été", "x1", "the", "of"]

    def make(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "-", "  "]) for _ in range(n))

    items = [(i, make(rng.choice([1, 3, 5, 6, 9]))) for i in range(25)] + [(100, ""), (101, None), (3, "a a a a a")]
    items += [(None, "a a a"), (None, "x1 of the B été")]
    docs = [(i, make(rng.randint(0, 60))) for i in range(60)] + [(900, None), (901, ""), (902, "--"), (0, "a été")]
    docs += [(903 + i, "x " + items[i][1] + make(4)) for i in range(10)]
    return docs, items


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination_agrees_with_trying_all_windows(spark, block):
    docs, items = decontamination_case()
    rows = [(n, i, t, "own") for n, (i, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, "nr int, doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(df, bench, window=5, block_bytes=block)
    by_nr = {r["nr"]: r for r in got.withColumn("bad", is_contaminated()).collect()}
    assert len(by_nr) == len(docs)
    for nr, (_, text) in enumerate(docs):
        n, n_hit, names, hit = plain_decontamination(text, items, 5)
        row = by_nr[nr]
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, n_hit, names)
        assert row["bad"] == (n_hit > 0 and 20 * n_hit >= n)
        spans = [(s["start"], s["end"]) for s in row["hit_spans"]]
        words = list(WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        inside = {i for i, m in enumerate(words) if any(a <= m.start() and m.end() <= b for a, b in spans)}
        assert inside == hit
    assert any(plain_decontamination(t, [i for i in items if i[0] is None], 5)[1] for _, t in docs)
    assert decontaminate(df.limit(0), bench).count() == 0
    assert decontaminate(df, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def plain_boilerplate(rows, ratio, min_pages):
    from collections import Counter

    def bare(line):
        return line.strip(" \t\r")

    pages, lines = Counter(h for _, h, _ in rows), Counter()
    for _, host, text in rows:
        lines.update({(host, bare(x)) for x in (text or "").split("\n") if text is not None and bare(x)})
    often = {k for k, n in lines.items() if n >= min_pages and n > ratio * pages[k[0]]}
    out = []
    for nr, host, text in rows:
        if text is None:
            out.append((nr, 0, 0, None))
            continue
        every = text.split("\n")
        kept = [x for x in every if (host, bare(x)) not in often]
        out.append((nr, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [1000, 0])
def test_boilerplate_agrees_with_counting(spark, most):
    rng = random.Random(5)
    lines = ["menu", " menu\t", "footer", "", "  ", "é", *[f"line {i}" for i in range(30)]]
    rows = []
    for nr in range(200):
        host = rng.choice(["a", "a", "a", "b", "c", None, "null"])
        text = "\n".join(rng.choices(lines[:6] if rng.random() < 0.3 else lines, k=rng.randint(1, 8)))
        rows.append((nr, host, rng.choice([text, text, text, "", None])))
    rows += [(500, "tiny", "menu\nmenu"), rows[0]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "nr int, source string, text string, n_lines int")
    got = drop_boilerplate(df, ratio=0.3, min_pages=3, most_broadcast=most)
    assert set(got.columns) == {"nr", "source", "text", "n_lines", "n_dropped", "clean_text"}
    found = [tuple(r[c] for c in ("nr", "n_lines", "n_dropped", "clean_text")) for r in got.collect()]
    assert sorted(found, key=repr) == plain_boilerplate(rows, 0.3, 3)
    assert drop_boilerplate(df.limit(0), most_broadcast=most).count() == 0


def test_native_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a", "x")], "nr int, source string, text string")
    plan = drop_boilerplate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_line_dedup_sql_is_null_safe(spark):
    import duckdb
    import pandas as pd

    from instructspark.llm.queries import ORACLES

    common = "\n".join(f"menu line {i}" for i in range(3))
    rows = [(i, None if i % 4 == 0 else "s", f"{common}\nown {i}" if i % 7 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sorted(tuple(r) for r in drop_boilerplate(df).select("doc_id", "source", "n_lines", "n_dropped", "clean_text").collect())
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "source", "text"]))
    want = sorted(tuple(r) for r in db.execute(ORACLES["op8_line_dedup"]).fetchall())
    assert got == want
    assert any(r[1] is None and r[3] > 0 for r in got) and any(r[2] == 0 for r in got)
