import random
import re

from maskwright.llm import urls
from maskwright.llm.catalog import URL_RULES


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_rules_against_a_plain_version(spark):
    rng = random.Random(2)
    hosts = ["example.com", "www.example.com", "a.www.EXAMPLE.com", "notexample.com", "x.net", "net", "com", "", "com.evil.org",
             "éxample.com", "example.com:80", "a*b.net"]
    paths = ["", "/", "/en/", "/en", "/en/x.com/es/", "/es/1", "/fr/é", "//", "/EN/", "/net/es/"]
    tails = ["", "?a=/en/", "#://x.com/", "?", "\n"]
    rows = [f"{rng.choice(['http', 'https', '', 'a b'])}://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    rows += [None, "", "example.com/en/", "://", "http:/x.com/", "http://a://b.com/en/", "http://x.net/es/" + "y" * 30_000]
    df = spark.createDataFrame([(i if i % 7 else None, u, "h", "r") for i, u in enumerate(rows)],
                               "page_id bigint, url string, host string, rule string")
    found = urls.judge_urls(df, [urls.host_rule(*r) for r in URL_RULES]).collect()
    want = [(i if i % 7 else None, *plain(u, URL_RULES)) for i, u in enumerate(rows)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_globs_against_regular_expressions():
    rng = random.Random(6)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "."]) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    automaton = urls.Automaton(globs)
    assert automaton.words > 2
    import numpy as np
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    sets = automaton.run(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    form = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    for glob, (word, bit) in zip(globs, automaton.ends):
        # runs of stars read from the left, as pairs first
        rule = re.compile("".join(form.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob)), re.S)
        assert [bool(rule.fullmatch(t)) for t in texts] == (sets[:, word] & bit != 0).tolist(), glob


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert [tuple(r) for r in urls.judge_urls(df, [], "block").collect()] == [(1, "a.com", "/", None, "block")]
    assert urls.judge_urls(df.limit(0), [urls.host_rule("block", "com", "/")]).count() == 0
