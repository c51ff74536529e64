import math
import random
import re
from collections import defaultdict

from tidelake.llm import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block")]


def expected(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://ORG", "https://a.ORG/x?y#z", "http://example.org/en/12", "http://x.example.org/es/",
        "http://notexample.org/es/1", "http://a.com/fr/1", "ftp://a.com/de/1://b", "http://a.com?x=/de/", "http://a.com#/fr/", "x://É.com/de/ü",
        "http://com/fr/", "http://a.net/\n/b", "a\nb://c.org/d"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    found = {r.page_id: r for r in url_filter.filtered(pages).collect()}
    for i, url in enumerate(URLS):
        host, path, (rule, verdict) = expected(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), url
        assert found[i].verdict == verdict if rule else found[i].verdict in ("allow", "block")
    assert url_filter.filtered(pages.limit(0)).count() == 0


def test_labelled_templates_decide_the_rest(spark):
    """Branches that are blocked elsewhere are rejected where no rule fits; many rare names become one wildcard."""
    urls = [f"http://a.com/de/{i}" for i in range(50)] + [f"http://a.com/fr/{i}" for i in range(50)]
    urls += [f"http://b.net/de/{i}" for i in range(20)] + [f"http://b.net/fr/{i}" for i in range(20)]
    urls += [f"http://b.net/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}/home" for i in range(60)] + [None, None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    verdicts = {r.page_id: r.verdict for r in url_filter.filtered(pages).collect()}
    assert {verdicts[i] for i in range(100, 120)} == {"block"}
    assert {verdicts[i] for i in range(120, 140)} == {"allow"}
    rows = pages.select("page_id", url_filter.host_of(pages.url).alias("host"), url_filter.templates(url_filter.path_of(pages.url))
                        .alias("template")).selectExpr("*", "CAST(NULL AS STRING) AS label")
    merged = {tuple(r.t) for r in url_filter.tree(rows).where("host = 'b.net'").collect()}
    assert merged == {("de", "{n}"), ("fr", "{n}"), ("user", "{*}", "home")}


def plain_tree(rows, spread):
    """The tree by dictionaries: rows (host, template, label) to the merged template of each (host, template)."""
    nodes = defaultdict(lambda: [0, 0, 0])
    for host, t, label in rows:
        nodes[host, t][0] += 1
        nodes[host, t][1 if label == "allow" else 2] += label is not None
    now = {key: key[1] for key in nodes}
    for level in range(max(len(t) for _, t in nodes)):
        leaf = defaultdict(lambda: [0, 0, 0.0])
        for key, t in now.items():
            if len(t) > level:
                n, good, bad = nodes[key]
                one = leaf[key[0], t[:level], t[level]]
                one[0] += n
                if good + bad:
                    one[1] += 1
                    one[2] += bad / (good + bad)
        families = defaultdict(list)
        for (host, up, name), values in leaf.items():
            families[host, up].append((name, *values))
        wild = set()
        for (host, up), children in families.items():
            pages, every = sum(c[1] for c in children), sum(c[2] for c in children)
            mean = (sum(c[3] for c in children) + 0.5) / (every + 1)
            small = [c for c in children if c[1] * spread <= pages]
            for name, _, m, p in small if len(small) > spread else ():
                if not name.startswith("{") and abs(p - mean * m) <= 2 * math.sqrt(mean * (1 - mean) * m) + 0.5:
                    wild.add((host, up, name))
        now = {k: t[:level] + ("{*}",) + t[level + 1:] if len(t) > level and (k[0], t[:level], t[level]) in wild else t for k, t in now.items()}
    return now


def test_tree_equals_plain_and_does_not_depend_on_the_number_of_pages(spark):
    rng = random.Random(5)
    rows = [("a", ("user", f"u{i}", rng.choice(["home", "posts"])), rng.choice([None, "allow", "block"])) for i in range(60) for _ in range(4)]
    rows += [("a", ("top", f"x{i}", *[f"d{j}" for j in range(10)], f"y{i % 7}"), "block" if i < 3 else "allow") for i in range(40)]
    rows += [("b", (f"s{i}", "{n}"), "allow") for i in range(15)] + [("b", (), None), ("", ("z",), None)]
    rows += [("c", ("shop", f"bad{i // 30}", f"p{i}"), "block") for i in range(60)] + [("c", ("shop", f"good{i}", "p"), "allow") for i in range(300)]
    want = plain_tree(rows, 20)
    assert ("user", "{*}", "home") in want.values() and any(len(t) > 12 and t[1] == "{*}" for t in want.values())
    assert {t[1] for (h, _), t in want.items() if h == "c"} == {"{*}", "bad0", "bad1"}
    for times in (1, 10):
        table = spark.createDataFrame(rows * times, "host string, template array<string>, label string").repartition(4)
        assert {(r.host, tuple(r.source)): tuple(r.t) for r in url_filter.tree(table).collect()} == want
