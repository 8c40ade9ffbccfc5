"""URL filter, license scan, host rules and mixing against plain Python on edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.llm import host_quality, license_scan, mixing, url_filter


# --- url filter -------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "x://net/es/",
        "x://a.net/fr/q", "x://annet/fr/", "x://example.com", "x://example.com?/en/", "x://com/", "x://.com/", "x://a..com/en",
        "http://b.example.com/en", "http://b.example.com/EN/", "a://b://c.net/es/", "http://example.com:80/en/",
        "http://É.example.com/en/é", "http://www.example.com/en/" + "p/" * 3000, "x://" + "a." * 300 + "net/fr/"]


def url_verdict(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("rules", [url_filter.RULES, [("block", "com", "/e"), ("allow", "com", "/e"), ("block", "b.example.com", ""),
                                                      ("allow", "example.com", "/en"), ("block", "net", "/")], []])
def test_urls(spark, rules):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS)] + [(3, URLS[4], "h", "p"), (None, URLS[5], "h", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    rf = spark.createDataFrame(rules, "action string, host string, path string")
    got = Counter(tuple(r) for r in url_filter.filter_urls(df, rf).collect())
    assert got == Counter((i, *url_verdict(u, rules)) for i, u, _, _ in rows)
    assert url_filter.filter_urls(df.limit(0), rf).collect() == []


# --- license scan -----------------------------------------------------------------------------

PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def license_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(license_scan.WORDS, low)
    hits = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words))
            if tuple(words[k:k + len(phrase)]) == phrase]
    starts = [k for k, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in hits})))


def test_licenses(spark):
    rng = random.Random(4)
    parts = ["CC BY", "cc-by", "cc", "by", "General Public License", "general public", "All rights", "reserved", "all rights reserved.",
             "Released under the MIT License.", "mit", "Licensed under the Apache License, Version 2.0", "é", "ÀLL", "KK", "123", "license",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "\n", "x_y"]
    texts = [None, "", "\n\t", "İ all rights reserved", *[" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(150)],
             "cc by " * 4000, "word " * 20_000 + "all rights reserved"]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, "cc by", "x", 1), (5, texts[5], "x", 7)],
                               "doc_id long, text string, words string, t int")
    rows = license_scan.scan(df).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "cc by" if r["doc_id"] is None else texts[r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == license_base(text)
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        low = (text or "").lower()
        assert ("mit" in r["labels"].split(",")) <= ("mit license" in low)
        assert ("apache" in r["labels"].split(",")) == ("licensed under the apache license, version" in low)
    assert license_scan.scan(df.limit(0)).collect() == []


def test_license_places_are_intersections(spark):
    templates = [license_scan.Template("mit", "released under the mit license", "mit license"),
                 license_scan.Template("cc", "by cc by", "by cc by"), license_scan.Template("gpl", "public license", "public license", True)]
    weights = {"mit": 9, "cc": 8, "by": 5, "public": 4, "license": 3, "released": 2, "under": 1, "the": 1}
    index = license_scan.index_of(templates, weights)
    assert index == {"mit": [(0, 3)], "license": [(0, 4)], "cc": [(1, 1)], "by": [(1, 0)], "public": [(2, 0)]}
    texts = {"mit mit license": [(0, -2)], "mit": [], "license license": [], "mit x license": [], "public": [(2, 0)],
             "cc by cc by": [(1, 1)], "by cc mit license": [(0, -1), (1, 0)], "": []}
    df = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "doc_id int, words array<string>")
    got = {r["doc_id"]: [tuple(p) for p in r["places"]] for r in license_scan.candidates(df, index, 3).collect()}
    assert got == dict(enumerate(texts.values()))


# --- host rules -------------------------------------------------------------------------------

def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered))


def test_host_rules(spark):
    rng = random.Random(6)
    words = ["a", "b", "Ünï", "#x", "<y>", "c", "d\u00a0e", "日本"]
    texts = [None, "", "\n\n", "a b c a b c", "a a a a", "x " * 60]
    texts += ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(rng.randrange(0, 200)))
              for _ in range(120)]
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(50, 300))) for _ in range(100)]
    rows = [(i, t, rng.choice(["good", "bad", None]) if t and t.startswith("w") else "bad", 3, True) for i, t in enumerate(texts)]
    rows += [rows[0], rows[8], (None, "a b", "bad", 3, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, kept boolean")
    got = host_quality.judge(host_quality.measure(df, F.struct("doc_id", "source")), F.col("carried.source")).collect()
    assert len(got) == len(rows)
    failed = lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0]
    strict = lambda m: 100 * m[2] > 5 * m[1] or 100 * m[4] > 20 * m[0] or m[3] > 0
    hosts = defaultdict(list)
    for _, t, s, *_ in rows:
        if s is not None:
            m = measures(t)
            hosts[s].append(failed(m) or strict(m))
    n, k = sum(map(len, hosts.values())), sum(map(sum, hosts.values()))
    strength = host_quality.prior_strength(len(hosts), n, k, sum(sum(x) ** 2 / len(x) for x in hosts.values()))
    bad = {s for s, x in hosts.items() if round((sum(x) + k / n * strength) / (len(x) + strength), 9) >= host_quality.BAD_RATE}
    assert bad == {"bad"}
    by_id = {i: (t, s) for i, t, s, *_ in rows}
    for r in got:
        text, source = by_id[r["carried"]["doc_id"]]
        m = measures(text)
        assert tuple(r[f] for f in host_quality.FIELDS) == m
        assert r["base_failed"] == failed(m) and r["kept"] == (not failed(m) and not (source in bad and strict(m)))
    kept = host_quality.keep_documents(df)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in got)
    assert host_quality.keep_documents(df.limit(0)).collect() == []


# --- mixing -----------------------------------------------------------------------------------

def share(budget, children):
    """Water-filling: [(cap, weight)] -> amounts, whole tokens."""
    out, rest = [None] * len(children), sorted(range(len(children)), key=lambda k: (children[k][0] * 1_000_000 // children[k][1], children[k]))
    while rest:
        weight = sum(children[k][1] for k in rest)
        k = rest[0]
        if children[k][0] * weight <= budget * children[k][1]:
            out[k] = children[k][0]
            budget -= children[k][0]
            rest = rest[1:]
        else:
            for k in rest:
                out[k] = min(children[k][0], max(0, budget) * children[k][1] // weight)
            break
    return out


def test_mixing(spark):
    rng = random.Random(9)
    langs, sources = ["en", "de", None], ["src1", "src12", "src2", None]
    rows = []
    for i in range(400):
        hot = rng.random() < 0.4
        text = rng.choice([None, "", "w " * rng.randrange(1, 60)]) if rng.random() < 0.1 else "w " * rng.randrange(1, 60) + str(i)
        rows.append((i, text, "en" if hot else rng.choice(langs), "src1" if hot else rng.choice(sources), "x", 1))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens string, copies int")
    weights = {"domain": {"core": 5}, "lang": {"en": 1, "de": 7}, "source": {"src1": 1, "src12": 3}}
    for percent, epochs in ((100, 4), (30, 1), (500, 2)):
        leaves = mixing.with_leaves(df, mixing.domain_of(F.col("source")), row=F.struct(*df.columns))
        got = mixing.select(leaves, weights, percent, epochs).collect()
        supply = Counter()
        tree = defaultdict(set)
        for _, text, lang, source, *_ in rows:
            domain = None if source is None else "core" if re.fullmatch(r"src\d", source) else "tail"
            supply[domain, lang, source] += len((text or "").split())
            for depth in range(3):
                tree[(domain, lang, source)[:depth]].add((domain, lang, source)[:depth + 1])
        below = lambda node: sum(n for leaf, n in supply.items() if leaf[:len(node)] == node)
        plan = {}

        def go(node, budget):
            if len(node) == 3:
                plan[node] = budget
                return
            children = list(tree[node])
            level = mixing.LEVELS[len(node)]
            pairs = [(below(c) * epochs, weights[level].get(c[-1], 1)) for c in children]
            for c, amount in zip(children, share(budget, pairs)):
                go(c, amount)

        go((), sum(supply.values()) * percent // 100)
        taken = Counter()
        for r in got:
            taken[r["domain"], r["lang"], r["source"]] += r["tokens"] * r["copies"]
            assert 0 < r["copies"] <= epochs
        longest = 61
        for leaf, amount in plan.items():
            assert amount <= taken[leaf] < amount + longest or supply[leaf] == 0 or amount == taken[leaf] == 0, leaf
        again = mixing.select(leaves.repartition(7), weights, percent, epochs).collect()
        assert Counter(map(str, got)) == Counter(map(str, again))
    mixed = mixing.mix_documents(df, weights)
    assert mixed.columns == df.columns
    assert math.isclose(mixed.select(F.sum(F.size(F.expr("filter(split(text, ' '), x -> x != '')")))).first()[0],
                        sum(supply.values()), rel_tol=0.2)
    assert mixing.mix_documents(df.limit(0), weights).collect() == []


def test_a_shortage_stays_in_the_family():
    # the second child lacks 60 of its 80; its sibling takes them
    assert share(160, [(500, 1), (20, 1)]) == [140, 20]
