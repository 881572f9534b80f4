import random
import re

from tollhouse.llm.queries import URL_GLOBS, URL_RULES, URL_WORDS
from tollhouse.llm.url_rules import GlobAutomaton, judged


def glob_regex(glob):
    return re.compile("".join(".*" if t.startswith("**") else "[^/]*" if t == "*" else re.escape(t) for t in re.findall(r"\*\*+|\*|[^*]", glob, re.DOTALL)), re.DOTALL)


def test_automaton_against_regular_expressions():
    rng = random.Random(4)
    for _ in range(40):
        globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "é"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        urls = ["".join(rng.choice("ab/é") for _ in range(rng.randint(0, 12))) for _ in range(40)] + ["", "a" * 300]
        hit = GlobAutomaton(globs).matches(urls)
        for i, u in enumerate(urls):
            for j, g in enumerate(globs):
                assert hit[i, j] == bool(glob_regex(g).fullmatch(u)), (g, u)
    assert GlobAutomaton(["a"]).matches([]).shape == (0, 1)


def brute(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    blocked = any(glob_regex(g).fullmatch(host + (path or (host and "/"))) for g in URL_GLOBS)
    assert blocked == bool(re.search("(^|[.-])(" + "|".join(URL_WORDS) + ")([-.:]|$)", host, re.DOTALL)), url
    return host, path, best.name if best else None, best.verdict if best else "block" if blocked else "allow"


def test_judged(spark):
    hosts = ["example.com", "www.example.com", "m.www.example.com", "xexample.com", "com", "a.net", "net", "b.org", "casino-win.org", "casino.org", "my-casino", "a.porn.b:8", "adulteducation.edu", "spam", "xads.org", "WWW.Example.COM", "É.com", "a.com:80", "u@b.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/1?x=/es/", "/es/x", "/fr/", "#top", "?q=://c.com/", "/de/adult/", "/x.com/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "", "a://b://") for h in hosts for p in paths] + [None, "", "x", "http://" + "a" * 5000 + ".com/", "line\n://a.net/es/\nx"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(0, urls[0], "", "")], "page_id long, url string, host string, verdict string").repartition(3)
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged(pages, URL_RULES, URL_GLOBS).select("page_id", "host", "path", "rule", "verdict").na.fill("-", ["rule"]).collect())
    want = sorted((i, h, p, r or "-", v) for i, u in [*enumerate(urls), (0, urls[0])] for h, p, r, v in [brute(u)])
    assert got == want
    assert judged(pages.limit(0), URL_RULES, URL_GLOBS).collect() == [] and judged(pages, [], []).where("verdict = 'allow'").count() == len(urls) + 1
