"""URL filter, line dedup and licence scan."""

import random

from pyspark.sql import functions as F

from tillstream.llm import licences, line_dedup, url_filter
from tillstream.llm.queries import URL_RULES


def test_cascade_is_exact_over_its_universe(spark):
    rnd = random.Random(1)
    listed = {f"key{rnd.randint(0, 10**6)}" for _ in range(300)}
    others = {f"other{i}" for i in range(20_000)}
    keys = spark.createDataFrame([(k,) for k in listed | others], "key string")
    wanted = spark.createDataFrame([(k,) for k in listed] + [(None,)], "key string")
    levels = url_filter.build_cascade(wanted, keys, bits_per_key=4, hashes=2)  # many false positives: several levels
    assert len(levels) >= 3
    found = {r.key for r in keys.filter(url_filter.member(levels, F.col("key"))).collect()}
    assert found == listed
    assert url_filter.build_cascade(wanted.limit(0), keys) == []


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/", "https://a.b.Example.NET/en/x?y#z", "https://example.net/english", "x://net",
            "http://org/fr/1", "http://borg/fr/1", "http://a.example.com/de/", "http://example.com/de", "http://example.com/de/?q", "a://b://c.net/",
            "http://" + "x." * 5000 + "net/" + "p" * 10_000, "http://example.org/fr/#", "http://example.net/en/", "http://example.net/en/"]
    pages = spark.createDataFrame([(i, u, "h", "p", "r", "v") for i, u in enumerate(urls)], "page_id bigint, url string, host string, path string, rule string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert found == {i: judge(u) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


def test_repeated_lines(spark):
    same = "one  Two three\tfour five"
    docs = spark.createDataFrame([
        (3, f"x\n{same}\n\nend of", 0, "d"), (1, f"é\n{same.upper()}", 0, "d"), (None, same, 0, "d"), (2, None, 0, "d"), (4, "", 0, "d"),
        (5, "a b\na b", 0, "d"), (6, f"{same}\n{same}", 0, "d"), (6, f"{same}\n{same}", 0, "d"), (7, "w " * 40_000, 0, "d")],
        "doc_id bigint, text string, start int, digest string")
    found = sorted((tuple(r) for r in line_dedup.repeated_units(docs).collect()), key=repr)
    expected = [(3, 1, 2, 24, 1, 1), (None, 0, 0, 24, 1, 1)] + [(6, 0, 0, 24, 1, 1), (6, 1, 25, 24, 1, 1)] * 2
    assert found == sorted([*expected, (5, 1, 4, 3, 5, 0)], key=repr)
    long_enough = line_dedup.repeated_units(docs, min_words=5).collect()
    assert sorted((tuple(r) for r in long_enough), key=repr) == sorted(expected, key=repr)
    short = spark.createDataFrame([(1, "同じ行"), (2, "x\n同じ行\n\n \n"), (3, " \n")], "doc_id bigint, text string")
    assert [tuple(r) for r in line_dedup.repeated_units(short).collect()] == [(2, 1, 2, 3, 1, 0)]
    one = docs.filter("doc_id IN (3, 1)")
    kept = {r.doc_id: r.text for r in line_dedup.without_units(one, line_dedup.repeated_units(one)).collect()}
    assert kept == {1: f"é\n{same.upper()}", 3: "x\n\n\nend of"}
    assert line_dedup.repeated_units(docs.limit(0)).collect() == []
    paragraph = spark.createDataFrame([(1, "a b\nc d e\n\nzz"), (2, "q\n\nA B C D E")], "doc_id bigint, text string")
    assert [(r.doc_id, r.unit, r.start) for r in line_dedup.repeated_units(paragraph, unit="paragraph").collect()] == [(2, 1, 3)]


def test_licences(spark):
    mit = dict(reversed(licences.KNOWN))["MIT"]
    spelled = "Copyright (c) 2020 Someone\nAll rights reserved.\n" + licences.KNOWN[0][1].upper().replace("SUBLICENSE", "sub-licence").replace(",", " ;")
    docs = spark.createDataFrame([
        (1, spelled, "x", 1), (2, "first\nReleased under the M.I.T. License", "x", 1), (3, "first\n  released UNDER the MIT licence!!\nlast", "x", 1),
        (4, None, "x", 1), (5, "", "x", 1), (None, "Licensed under CC BY-NC 4.0.", "x", 1), (6, "under " * 30_000, "x", 1), (7, "Copyright 1999", "x", 1),
        (3, "first\n  released UNDER the MIT licence!!\nlast", "x", 1)], "doc_id bigint, text string, licence string, line int")
    found = sorted((tuple(r) for r in licences.scan_licences(docs).collect()), key=repr)
    assert mit and found == sorted([
        (1, "text", None, "MIT"), (3, "line", 1, "MIT"), (3, "line", 1, "MIT"),
        (None, "text", None, "CC-BY-NC-4.0"), (None, "line", 0, "CC-BY-NC-4.0")], key=repr)
    assert licences.scan_licences(docs.limit(0)).collect() == []
    assert {r.licence for r in licences.scan_licences(docs, lines=False).collect()} == {"MIT", "CC-BY-NC-4.0"}


def test_every_known_text_is_found(spark):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(licences.KNOWN)], "doc_id bigint, text string")
    found = {r.doc_id: r.licence for r in licences.scan_licences(docs, lines=False).collect()}
    assert found == {i: name for i, (name, _) in enumerate(licences.KNOWN)}
