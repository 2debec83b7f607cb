"""Centroids, URL entries and collocations against SQL and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from allocspark.llm import centroids, collocations, queries, url_filter
from tests.oracle import connect, difference


@pytest.mark.parametrize("name", ["op11_collocations", "op12_centroids", "op13_url_filter"])
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf_dir, name, folder):
    sf_dir = sf_dir.replace("sf0.001", folder)
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name]) is None


def slow_clusters(rows, k, rounds, dims):
    """[(id, cluster, distance)], centroids: all distances, in Python's integers."""
    fine = [(i, [math.floor(x * 256) if abs(x) < 1e15 else int(x) * 256 for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~"
    points = [q for _, q in sorted(fine, key=lambda r: (digest(r[0]), r[1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        near = [min((apart(q, c), n) for n, c in enumerate(points)) for _, q in fine]
        if turn < rounds:
            for n in range(len(points)):
                mine = [q for (_, q), (_, m) in zip(fine, near) if m == n]
                if mine:
                    points[n] = [sum(column) // len(mine) for column in zip(*mine)]
    return [(i, n, d) for (i, _), (d, n) in zip(fine, near)], points


@pytest.mark.parametrize("huge", [False, True])
def test_clusters_equal_all_distances(spark, huge):
    draw = random.Random(7 + huge)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.0, 1.0, 0.5, draw.gauss(0, 3)]) for _ in range(4)]) for i in range(300)]
    rows += [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None, 1.0, 1.0]), (5, [float("nan")] * 4), (6, [float("inf")] * 4),
             (None, [1.0] * 4), (None, [2.0] * 4), (7, rows[7][1]), (7, rows[7][1]), (8, [-2.0] * 4)]
    if huge:
        rows += [(1000 + i, [draw.gauss(0, 1) * 10.0 ** draw.randint(6, 300) for _ in range(4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).selectExpr("*", "'x' as cluster", "'y' as inertia")
    found = centroids.cluster(df, k=9, rounds=4, dims=4).collect()
    wanted, points = slow_clusters(rows, 9, 4, 4)
    lost = lambda d: d if d is not None and d < 1 << 63 else None
    assert Counter((r.vec_id, r.cluster, r.distance) for r in found) == Counter((i, c, lost(d)) for i, c, d in wanted)
    sums = {c: sum(d for _, m, d in wanted if m == c) for c in range(9)}
    for r in found:
        assert r.cluster_inertia == lost(sums[r.cluster]) or any(m == r.cluster and lost(d) is None for _, m, d in wanted)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, points[r.cluster])).encode()).hexdigest()
        assert r.inertia == lost(sum(sums.values()))


def test_clusters_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<double>")
    found = centroids.cluster(df, dims=2).collect()
    assert {(r.vec_id, r.cluster, r.distance, r.inertia) for r in found} == {(1, 0, 0, 0)} and len(found) == 2
    assert centroids.cluster(df.where("false"), dims=2).collect() == centroids.cluster(df, dims=3).collect() == []


def test_digits_add_up():
    for numbers in ([0, -1, 1], [2**200 - 3, -(2**200), 5], [-(2**48), 2**48 - 1, 2**47]):
        parts = centroids._digits(numbers)
        assert [sum(p[i] << 48 * n for n, p in enumerate(parts)) for i in range(3)] == numbers


def slow_verdict(url, rules, default="allow"):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h.split(".")) if h else 0, len(p), v == "block", h + p, v) for v, h, p in rules
           if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


@pytest.mark.parametrize("trie_bytes", [8_000_000, 60])
def test_url_verdicts_equal_trying_every_entry(spark, trie_bytes):
    draw = random.Random(4)
    labels, segments = ["com", "net", "a", "bb", "example", "www", "A", ""], ["en", "e", "es", "", "x", "en-us"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randint(1, 4)))
    path = lambda: "".join("/" + draw.choice(segments) for _ in range(draw.randint(0, 4)))
    rules = [(draw.choice(["allow", "block"]), host().lower(), path()) for _ in range(60)] + [("block", "", "/x/x")]
    rules += [("allow", "b.com", "/e"), ("block", "b.com", "/e")]
    urls = [None, "", "://", "no scheme/a", "http://", "http://com", "http://com/", "http://COM?/en", "x://a.com#/en/", "http://b.com/es", "a://b://c/",
            "http://u@com:80/en/", "http://com/" + "en/" * 20_000, "HTTP://ÄB.com/É/", "//com/en"]
    urls += [f"https://{host()}{path()}{draw.choice(['', '?a=/b', '#c', '/'])}" for _ in range(1500)]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls + urls[:20])], "page_id long, url string, host string, Verdict string")
    found = url_filter.judge_urls(df, url_filter.rule_table(spark, rules), trie_bytes=trie_bytes)
    assert sorted(found.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    rows = found.collect()
    assert len(rows) == len(urls) + 20
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == slow_verdict(r.url, rules), r.url


def test_urls_without_rules_or_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = url_filter.rule_table(spark, [])
    assert [(r.rule, r.verdict) for r in url_filter.judge_urls(df, none, default="block").collect()] == [(None, "block")]
    assert url_filter.judge_urls(df.where("false"), url_filter.rule_table(spark, url_filter.RULES)).collect() == []
    with pytest.raises(Exception, match="neither allow nor block"):
        url_filter.judge_urls(df, url_filter.rule_table(spark, [("maybe", "com", "/")])).collect()


def slow_collocations(rows, support, top):
    """{lang: [(phrase, a, l, r, n, score)]}, by counting every phrase of one to four words."""
    counts, totals, result = {}, Counter(), {}
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und" if lang is None else lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts.setdefault("und" if lang is None else lang, Counter())[tuple(words[i:i + size])] += 1
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((" ".join(p), a, f[p[:k]], f[p[k:]], totals[lang], score))
        if scored:
            result[lang] = sorted(scored, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top]
    return result


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 50])
@pytest.mark.parametrize("support, top", [(30, 2_000), (3, 25)])
def test_collocations_equal_counting_every_phrase(spark, monkeypatch, chunk_bytes, support, top):
    draw = random.Random(support)
    words = ["New", "york", "new", "é", "日本", "of", "the", "--", "a\u00a0b", "x" * 50]
    end = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "; ", " ! ", "\r\n", "\x0b"]
    text = lambda n: "".join(draw.choice(words[:draw.randint(1, 10)]) + draw.choice(end) for _ in range(n))
    rows = [(text(draw.randint(0, 60)), draw.choice(["en", "de", None, "und", ""])) for _ in range(250)]
    rows += [(None, "en"), ("", None), (" \t\n", "de"), ("one", "fr"), ("New york of the " * 800, "en"), ("é" * 3000, "fr"), *[rows[5]] * 6]
    plain = collocations.chunks
    monkeypatch.setattr(collocations.chunks, "__defaults__", (chunk_bytes,))
    for texts in ([t or "" for t, _ in rows], [""], ["", "a b", "", "c d.", ""]):
        batch = collocations.pa.array(["cut off", *texts, "x"])[1:-1]
        seen = [(c.rows[i], *(c.words[c.codes[i + k]].as_py() for k in range(2))) for c in plain(batch, [""] * len(batch)) for i in c.starts(2)]
        wanted = [(n, *w[i:i + 2]) for n, t in enumerate(texts) for p in re.split(rb"[.,;:!?\x0A-\x0D]", t.encode().lower())
                  for w in [re.findall(rb"[^\x20\x09]+", p)] for i in range(len(w) - 1)]
        assert seen == wanted
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3).selectExpr("*", "1 as phrase", "2 as n", "3 as rank")
    found = {}
    for r in sorted(collocations.collocations(df, support=support, top=top).collect(), key=lambda r: r.rank):
        found.setdefault(r.lang, []).append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r.rank == len(found[r.lang])
    wanted = slow_collocations(rows, support, top)
    assert found == wanted and len(wanted) >= 3


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(f"a b c d{i % 3} e{i}, a b", "en") for i in range(200)], "text string, lang string")
    wanted = collocations.collocations(df).collect()
    monkeypatch.setattr(collocations, "_filter", lambda candidates: collocations.np.full(1024, 2**64 - 1, collocations.np.uint64))
    assert collocations.collocations(df).collect() == wanted and len(wanted) > 2


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([(None, None), ("one two", "en")], "text string, lang string")
    assert collocations.collocations(df).collect() == [] and collocations.collocations(df.where("false")).collect() == []
    assert {(r.lang, r.size, r.phrase, r.n) for r in collocations.phrase_counts(df).collect()} == {("en", 0, None, 2)}
