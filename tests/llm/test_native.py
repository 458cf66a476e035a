"""URL filters, chat formatting and sharding."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cabmeter.llm import chat, components, queries, shards, urls


def _find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1), (2, 3), (9, 8)],
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)] + [(70, 71), (71, 59)],
    [(30 - i, 60 - i) for i in range(25)] + [(i * 3, i * 7 % 50) for i in range(25)],
])
def test_components_match_union_find(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == _find(edges)


def test_url_cases(spark):
    rows = [
        (1, "http://Shop.EXAMPLE.com/en/a?x#y", None), (2, "http://www.example.com/en/1", None),
        (3, "https://a.net/fr/1", None), (4, "https://a.net/fr", None), (5, "https://com", None),
        (6, None, None), (7, "no scheme", None), (8, "http://x.org/1",
         '<link rel="canonical" href="https://a.net/fr/9">'), (9, "http://x.org/1#top", None),
        (10, "http://www.example.com/en/2", '<meta http-equiv="refresh" content="0; url=http://b.net/es/1">'),
        (11, "http://notcom/en/", None), (12, "", ""), (9, "http://x.org/1#top", None),
        (15, "https://x.org/5", '<link href="/9?a=1&amp;b=2" rel=canonical>'),
        (16, "https://x.org/6", '<LINK REL="canonical" HREF="//a.net/es/1">'),
        (17, "https://x.org/9?a=1&b=2", '<meta content="3;URL=https://b.net/fr/1" http-equiv=refresh>'),
        (18, "https://x.org/8", '<link rel="canonical" href="next.html"><link rel="icon" href="https://a.net/fr/9">'),
        (13, "http://telecom/x", None), (14, "http://x.com?u=http://a.net/fr/", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("component", F.lit("x"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in urls.judge_urls(df, queries.URL_RULES).collect()}
    assert got[1] == ("shop.example.com", "/en/a", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[3] == ("a.net", "/fr/1", "net/fr/", "block")
    assert got[4] == ("a.net", "/fr", None, "allow")
    assert got[5] == ("com", "", None, "allow")
    assert got[6] == got[7] == got[12] == ("", "", None, "allow")
    assert got[8] == ("x.org", "/1", None, "block")      # alias of a blocked address
    assert got[9] == ("x.org", "/1", None, "block")      # alias of that alias
    assert got[10][2:] == ("www.example.com/en/", "allow")  # its own allow holds
    assert got[11] == ("notcom", "/en/", None, "allow") and got[13][2] is None
    assert [got[i][3] for i in (15, 16, 17, 18)] == ["block", "block", "block", "allow"]
    assert got[14] == ("x.com", "", None, "allow")
    assert urls.judge_urls(df, queries.URL_RULES).count() == len(rows)
    assert urls.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_relative_and_differently_written_aliases(spark):
    link = '<link rel="canonical" href="%s">'
    refresh = '<meta http-equiv="refresh" content="0; url=%s">'
    bad = "https://a.net/fr/1"
    rows = [
        (1, "https://x.org/d/next.html", link % bad), (2, "https://x.org/d/p1", link % "next.html"),
        (3, "https://x.org/d/e/p2", refresh % "../next.html"), (4, "https://x.org/l?page=1", link % bad),
        (5, "https://x.org/l", refresh % "?page=1"), (6, "https://x.org/d/p3", link % "HTTPS://X.org/d/./next.html#top"),
        (7, "https://X.ORG/d/p3#a", None), (8, "https://x.org", link % "d/next.html"),
        (9, "https://x.org/other", link % "next.html"), (10, "https://x.org/mail", link % "mailto:next.html"),
        (11, "https://x.org/D/p3", None), (12, "https://x.org/d/q/", link % "../../../d/next.html"),
        (13, "https://x.org/l?page=2", link % "#top"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(df, queries.URL_RULES).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 2, 3, 4, 5, 6, 7, 8, 12} and len(got) == len(rows)
    cases = ["http://A.b/C?D#e", "http://a.b", "HTTP://a.B?q", "http://a.b/..", "http://a.b/c/.", "http://a.b/c/../d//e/..", "no/../x", ""]
    out = spark.createDataFrame([(c,) for c in cases], "u string").select(urls.normal_url(F.col("u"))).collect()
    assert [r[0] for r in out] == ["http://a.b/C?D", "http://a.b/", "http://a.b/?q", "http://a.b/", "http://a.b/c/", "http://a.b/d//", "no/../x", ""]


def test_an_empty_path_is_a_slash(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=%s">'
    rows = [(1, "https://a.net/fr/x", refresh % "https://y.org"), (2, "https://x.org/p", refresh % "https://y.org/"),
            (3, "https://y.org", None), (4, "https://y.org/other", None), (5, None, refresh % "https://y.org/")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(df, queries.URL_RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_page_graph_matches_resolver_and_union_find(spark, seed):
    """Pages of a few sites that link by every form of address; compared with
    the standard library's resolver and a union-find."""
    from urllib.parse import urldefrag, urljoin, urlsplit

    rng = random.Random(seed)
    sites = ["https://x.org", "http://Y.org", "https://a.net", "http://www.example.com", "https://b.example.com"]
    paths = ["", "/", "/fr/1", "/es/2", "/en/3", "/d/p", "/d/e/q", "/d/", "/l?p=1", "/l?p=2", "/m#x"]
    targets = ["p", "../p", "./q", "?p=1", "/d/p", "/fr/1", "//x.org/d/p", "e/../p", "..", "#x", "mailto:x", "/m"]

    def normal(u):
        parts = urlsplit(urldefrag(u).url)
        whole = f"{parts.scheme}://{parts.netloc.lower()}"
        return urljoin(whole + "/", (parts.path or "/") + ("?" + parts.query if parts.query else ""))

    def rule_of(u):
        host, path = urlsplit(u).netloc.lower(), urlsplit(u).path
        fits = [r for r in queries.URL_RULES
                if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.name), default=None)

    pages, edges = [], []
    for i in range(90):
        u = rng.choice(sites) + rng.choice(paths)
        to = rng.choice([None, rng.choice(targets), rng.choice(sites) + rng.choice(paths)])
        html = None if to is None else rng.choice([
            f'<link rel="canonical" href="{to}">', f'<meta http-equiv="refresh" content="0; url={to}">'])
        pages.append((i, u, html))
        edges.append((normal(u), normal(u)))
        if to is not None and not to.startswith(("#", "mailto:")):
            edges.append((normal(u), normal(urljoin(urldefrag(u).url, to))))
    root = _find(edges)
    blocked = {root[a] for a in root if (r := rule_of(a)) and r.verdict == "block"}
    want = {}
    for i, u, _ in pages:
        r = rule_of(u)
        want[i] = r.verdict if r else "block" if root[normal(u)] in blocked else "allow"
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(df, queries.URL_RULES).collect()}
    assert got == want and {"block", "allow"} == set(got.values())


def test_lookup_joins_plain_columns(spark, capsys):
    df = spark.createDataFrame([(1, "https://x.org/1", '<link rel="canonical" href="https://a.net/fr/9">')],
                               "page_id long, url string, html string")
    urls.judge_urls(df, queries.URL_RULES).explain()
    plan = capsys.readouterr().out
    assert "Join" in plan and "regexp" not in plan.split("Join", 1)[1]


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\INST]", "[\\\\/INST]<s>", "<\\s>", "", None, "a[", "<", "</s",
             "plain \\ text", "[[INST]]", "\\[INST]", "\n", "é" * 50_000, "<s><s>"]
    rows = [(c, t, r, x) for c, x in enumerate(nasty) for t, r in enumerate(["system", "user", "assistant"])]
    rows += [(99, 1, "assistant", "b"), (99, 1, "assistant", "a"), (99, None, None, "z"), (99, 1, "assistant", "a"),
             (None, 0, "[INST]", "x"), (100, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "turns", F.lit(1)).withColumn("formatted", F.lit("")).repartition(3)
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    out = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert set(out) == set(want)
    digests = {r["conv_id"]: r for r in chat.chat_digest(chat.format_chats(df)).collect()}
    for c, turns in want.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        o = out[c]
        assert [(t["role"], t["text"]) for t in o["turns"]] == turns
        assert sum(m["chars"] for m in o["loss_mask"]) == len(o["formatted"])
        at, masked = 0, []
        for m in o["loss_mask"]:
            if m["loss"]:
                masked.append(o["formatted"][at:at + m["chars"]])
            at += m["chars"]
        said = [x for r, x in turns if r == "assistant"]
        assert len(masked) == len(said)
        if not o["escaped"]:
            assert masked == said
        d = digests[c]
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert d["loss_sha256"] == hashlib.sha256("".join(said).encode()).hexdigest()
        assert (d["n_turns"], d["loss_chars"]) == (len(turns), sum(map(len, said)))
    assert out[0]["escaped"] and not out[4]["escaped"] and not out[100]["escaped"]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_reader_rejects_other_grammar(spark):
    bad = ["x", "[INST]user[/INST]a", "[INST]user</s>a[/INST]", "[INST]u[/INST]a</s>x", "<s>[INST]u[/INST]a</s>"]
    df = spark.createDataFrame([(b,) for b in bad], "f string")
    assert df.where(chat.parsed(F.col("f")).isNotNull()).count() == 0
    assert spark.createDataFrame([("",)], "f string").select(chat.parsed(F.col("f"))).first()[0] == []


@pytest.mark.parametrize("n", [0, 1, 7, 39, 40, 41, 1000])
def test_shards_are_even_and_mixed(spark, n):
    # One source holds most rows, one is null, some rows are repeated.
    rows = [(i if i % 50 else None, ["big", "big", "big", "b", None][i % 5], f"t{i}", 7) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    got = shards.stratified_shards(df, 40, group_rows=10).collect()
    assert len(got) == n
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert all(0 <= s < 40 for s in by)
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    if n >= 40:
        counts = [len(by[s]) for s in range(40)]
        assert max(counts) - min(counts) <= 1
    if n == 1000:
        for name, share in (("big", .6), ("b", .2), (None, .2)):
            for rs in by.values():
                assert abs(sum(r["source"] == name for r in rs) - share * len(rs)) <= 2
    again = shards.stratified_shards(df.repartition(5), 40, group_rows=10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("n", [0, 3, 700])
def test_documents_get_the_shards_of_their_rows(spark, tmp_path, n):
    # Copies of rows, rows of one key, null keys and sources; ``slot`` is replaced.
    rows = [(i // 3 if i % 50 else None, ["big", "big", "b", None][i % 4], f"t{i // 3 if i % 7 else i}", 7)
            for i in range(n)] + [(5, "big", "same", 7)] * (n // 3)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    want = sorted(map(str, shards.stratified_shards(df, 40, group_rows=10).collect()))
    got = shards.shard_documents(df, 40, group_rows=10)
    assert got.columns == ["doc_id", "source", "text", "shard", "slot"]
    assert sorted(map(str, got.collect())) == want
    df.repartition(3).write.parquet(str(tmp_path / "docs"))
    filed = spark.read.parquet(str(tmp_path / "docs")).select("doc_id", "source", "text")
    assert sorted(map(str, shards.shard_documents(filed, 40, group_rows=10).collect())) == want


def test_texts_stay_out_of_the_rankings(spark, sf_small, capsys):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    shards.shard_documents(docs, 40).explain("formatted")
    plan = capsys.readouterr().out
    assert "Window" not in plan and plan.count("Join") <= 4


def test_sized_rows(spark):
    df = spark.createDataFrame([(1, "é", "s", "en"), (2, None, "s", "en"), (3, "", None, None)],
                               "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in queries.sized_rows(df).collect()}
    import zlib
    assert got == {1: (18, zlib.crc32("é".encode())), 2: (16, 0), 3: (16, 0)}
