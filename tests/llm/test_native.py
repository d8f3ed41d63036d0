"""Line dedup, quality rules and URL reputation, against brute force and SQL."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from cinestar.llm import quality, url_filter
from cinestar.llm.line_dedup import Boilerplate, drop_boilerplate
from cinestar.llm.oracles import ORACLES
from cinestar.llm.queries import QUERIES, URL_RULES
from tests.compare import connect, differences
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []


def test_python_is_not_used(spark, capsys):
    for name in ("op1_line_dedup", "op9_quality"):
        QUERIES[name](spark, "/root/testdata/sf0.001").explain()
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_line_dedup_equals_brute_force(spark):
    settings = Boilerplate(max_ratio=0.2, min_pages=3)
    rows = cases.rows() + [(700 + k, f"Menu\n{'x ' * k}y\n\nMenu\n", "en", "s1", 1) for k in range(20)]
    pages, on = Counter(), Counter()
    for _, text, _, host, _ in rows:
        if host is not None:
            pages[host] += 1
            on.update((host, line) for line in set((text or "").split("\n")) if WORD.search(line))
    bad = {(h, line) for (h, line), n in on.items() if n > 0.2 * pages[h] and n >= 3}
    expected = Counter()
    for doc_id, text, _, host, _ in rows:
        lines = None if text is None else text.split("\n")
        kept = lines and [line for line in lines if (host, line) not in bad]
        expected[doc_id, None if text is None else "\n".join(kept), len(lines or []) - len(kept or [])] += 1
    frame = drop_boilerplate(cases.documents(spark, rows), settings)
    got = frame.select("doc_id", "text", "n_dropped_lines").collect()
    assert Counter(map(tuple, got)) == expected
    assert ("s1", "Menu") in bad
    assert frame.columns[-1] == "n_dropped_lines" and "lines" in frame.columns
    assert drop_boilerplate(cases.documents(spark, [])).count() == 0


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = defaultdict(list)
    for k in range(len(words) - 2):
        places[tuple(words[k : k + 3])].append(k)
    repeated = {k + d for found in places.values() if len(found) > 1 for k in found for d in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts_equal_brute_force(spark):
    rows = cases.rows() + [(800, "a b c " * 40 + "\n#1 <b>\n#1 <b>", "en", "s", 1), (801, "x x x x", "en", "s", 1)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality.judge(cases.documents(spark, rows))
    got = judged.select(*names, "kept").collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter((r[0], *counted(r[1])) for r in rows)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.judge(cases.documents(spark, [])).count() == 0


def test_divergence(spark):
    """Symbols and a list of rare words diverge from a language's prose; prose does not."""
    import random

    rng = random.Random(12)
    plain = "the of and in to a".split()

    def english(n):
        return " ".join(rng.choice(plain) if rng.random() < 0.4 else rng.choice(cases.SYLLABLES) + "x" for _ in range(n))

    rows = [(k, english(200), "en", "s", 1) for k in range(60)]
    rows += [(100, " ".join(f"w{k}###" for k in range(200)), "en", "s", 1)]
    rows += [(101, " ".join(f"{a}{b}{c}" for a in cases.SYLLABLES[:6] for b in cases.SYLLABLES[:6] for c in "pqr"), "en", "s", 1)]
    rows += [(102, rows[-1][1], "zz", "s", 1), (103, rows[-1][1], None, "s", 1)]
    kept = {r.doc_id: r.kept for r in quality.judge(cases.documents(spark, rows)).collect()}
    assert all(kept[k] for k in range(60))
    assert not kept[100] and not kept[101]
    assert kept[102] and kept[103]  # a reference of its own, and none


def test_js_distance(spark):
    row = spark.sql("SELECT array(1L, 3L, 0L) a, array(2L, 0L, 2L) b, array(0L, 0L, 0L) z")
    a, b, z = "a", "b", "z"
    from pyspark.sql import functions as F

    found = row.select(
        quality.js_distance(F.col(a), F.col(b)), quality.js_distance(F.col(a), F.col(a)), quality.js_distance(F.col(a), F.col(z))
    ).first()
    p, q = (0.25, 0.75, 0.0), (0.5, 0.0, 0.5)
    expected = sum(
        x * math.log2(2 * x / (x + y)) / 2 if x else 0.0 for one, two in ((p, q), (q, p)) for x, y in zip(one, two, strict=True)
    )
    assert found[0] == pytest.approx(math.sqrt(expected)) and found[1] == 0.0 and found[2] is None


def test_url_rules_and_reputation(spark):
    schema = "page_id bigint, url string"
    urls = [
        "http://a.net/x", "https://EXAMPLE.net/en/1?x#y", "http://www.example.com/de/", "http://example.com/de",
        "http://b.org/fr/x", "http://x.net?y=/", "http://planet/x", None, "no scheme", "http://bad.host.xyz/p", "http://", "HTTP://q.xyz#://z.net/",
    ]
    rows = list(enumerate(urls)) + [(100 + k, f"http://bad.host.xyz/{k}") for k in range(40)]
    rows += [(200 + k, f"http://good{k}.fine.xyz/") for k in range(40)] + [(300, "http://new.host.xyz/")]
    outcomes = [(100 + k, True) for k in range(40)] + [(200 + k, False) for k in range(40)] + [(0, None), (None, True), (999, True)]
    pages = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS host", "2 AS suffix", "3 AS share")
    labels = spark.createDataFrame(outcomes, "page_id bigint, bad boolean")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, labels, URL_RULES).collect()}
    found = [(r.host, r.path, r.rule, r.verdict) for r in (got[k] for k in range(len(urls)))]
    assert found == [
        ("a.net", "/x", "net/", "block"),
        ("example.net", "/en/1", "example.net/en/", "allow"),
        ("www.example.com", "/de/", "example.com/de/", "block"),
        ("example.com", "/de", None, "allow"),
        ("b.org", "/fr/x", "org/fr/", "allow"),
        ("x.net", "", None, "allow"),
        ("planet", "/x", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("bad.host.xyz", "/p", None, "block"),
        ("", "", None, "allow"),
        ("q.xyz", "", None, "allow"),
    ]
    # One suffix and two domains: shares and strengths by hand, 40 of 80 labelled pages are bad.
    overall = 40.5 / 81
    suffix = posterior([(40, 80, overall)])[0]
    domains = posterior([(40, 40, suffix), (0, 40, suffix)])
    hosts = posterior([(40, 40, domains[0]), *[(0, 1, domains[1])] * 40])
    assert got[300].bad_share == pytest.approx(domains[0]) and got[300].verdict == "block"
    assert got[100].bad_share == pytest.approx(hosts[0]) and 0.5 < got[100].bad_bound < 1
    assert got[200].bad_share == pytest.approx(hosts[1]) and got[200].verdict == "allow"
    # Nothing known of the host, or no host: the share of all pages.
    for k in (6, 7, 8, 10):
        assert got[k].bad_share == pytest.approx(overall) and got[k].verdict == "allow"
    bad = labels.withColumn("bad", labels.bad.isNotNull())
    everywhere = {r.page_id: r for r in url_filter.judge_urls(pages, bad, {}).collect()}
    assert everywhere[7].verdict == everywhere[6].verdict == "block" and everywhere[7].bad_bound < 1
    # Repeated pages and labels count each.
    twice = url_filter.judge_urls(pages.union(pages), labels.union(labels), URL_RULES)
    assert twice.count() == 2 * len(rows) and twice.where("page_id = 300").first().verdict == "block"
    assert url_filter.judge_urls(pages.where("false"), labels, URL_RULES).count() == 0
    none = url_filter.judge_urls(pages, labels.where("false"), URL_RULES)
    assert {r.verdict for r in none.where("rule IS NULL").collect()} == {"allow"}


def posterior(groups, weakest=1.0, strongest=10_000.0):
    """Shares of (bad, seen, prior) groups, shrunk by the strength that their scatter gives."""
    chance = [n * p * (1 - p) for _, n, p in groups]
    pairs = sum(v * (n - 1) for v, (_, n, _) in zip(chance, groups, strict=True))
    scatter = sum((x - n * p) ** 2 - v for v, (x, n, p) in zip(chance, groups, strict=True))
    strength = 1 / (scatter / pairs) - 1 if pairs and scatter > 0 else (strongest if pairs else weakest)
    strength = min(max(strength, weakest), strongest)
    return [(x + strength * p) / (n + strength) for x, n, p in groups]


def test_suffixes_and_domains(spark):
    from pyspark.sql import functions as F

    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "xco.uk", "a.xco.uk", "x.com", "w.x.com", "com", "", "1.2.3.4", "a.b.com.au"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = frame.select(url_filter.domain_of(F.col("host")), url_filter.suffix_of(F.col("host"))).collect()
    assert list(map(tuple, found)) == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("xco.uk", "uk"), ("xco.uk", "uk"),
        ("x.com", "com"), ("x.com", "com"), ("", "com"), ("", ""), ("3.4", "4"), ("b.com.au", "com.au"),
    ]


def test_lower_bound_is_a_beta_quantile(spark):
    """Against quantiles by sums over a fine grid."""
    import numpy as np
    from pyspark.sql import functions as F

    x = (np.arange(200_000) + 0.5) / 200_000
    cases_ = [(0.5, 2.0), (0.9, 10.0), (0.99, 1.0), (0.1, 50.0), (0.7, 1000.0), (0.6, 0.5)]
    frame = spark.createDataFrame(cases_, "share double, weight double")
    found = frame.select(url_filter.lower_bound(F.col("share"), F.col("weight"), 1.645)).collect()
    for (share, weight), (bound,) in zip(cases_, found, strict=True):
        a, b = weight * share + 1, weight * (1 - share) + 1
        density = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
        mass = np.cumsum(np.exp(density - density.max()))
        assert bound == pytest.approx(x[np.searchsorted(mass, 0.05 * mass[-1])], abs=0.01 if weight >= 10 else 0.045)
