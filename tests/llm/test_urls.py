"""Host rules against plain Python, segmentation and naive Bayes on small data."""

import math
import random
from collections import Counter

from shelfline.llm import urls as U

URLS = [
    "http://example.com/en/1", "https://www.example.com/en/2", "https://A.Example.COM/en/x?q#f", "http://x.net/es/", "http://x.net/es",
    "http://net/fr/a", "http://xnet/fr/a", "http://b.org", "http://b.com", "http://b.com?x", "http://b.com#y", "noscheme.com/en/",
    None, "", "a://b://c.net/fr/", "http:///p", "ftp://É.com/Ü?x", "http://b.com:80/", "http://net./es/", "http://u\nv.com/\n#",
]


def plain(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3:]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for h, p, v in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


def test_rules(frame):
    pages = frame([(i, u, 1, None) for i, u in enumerate(URLS)], "page_id long, url string, host int, html string")
    rows = U.judge(pages, U.learn(pages)).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or "allow")


def test_segmentation():
    split = U.Segmenter({"the": 100, "rapist": 1, "cheap": 50, "pills": 50, "they": 30, "an": 20})
    assert split("cheappills") == ["cheap", "pills"]
    assert split("thecheap") == ["the", "cheap"]
    assert split("") == []
    assert "".join(split("zzthezz" * 50)) == "zzthezz" * 50


def test_learned_verdicts(frame, spark):
    good = "<p>" + "the cheap pills news and good words here " * 3 + "</p>"
    rows = [(i, f"http://news{i % 3}.org/en/", good) for i in range(30)]
    rows += [(100 + i, "http://cheappills.org/x", good) for i in range(10)]
    rows += [(200, None, None), (201, "http://q.org/", "<p>%%% a### $$$</p>")]
    pages = frame(rows, "page_id long, url string, html string")
    verdict = {r.page_id: r.verdict for r in U.judge(pages, U.learn(pages)).collect()}
    assert len(verdict) == len(rows)
    assert {verdict[100 + i] for i in range(10)} == {"block"}
    assert {verdict[i] for i in range(30)} == {"allow"}
    assert verdict[200] == "allow"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(empty, U.learn(empty)).count() == 0


def test_weak_label():
    assert U.looks_bad("De%%% eux*** la### mot$$$ un")
    assert U.looks_bad("THE!! ER!! ORES,!!")
    assert not U.looks_bad("a plain sentence, with 5 % of nothing & more words to read here!")
    assert not U.looks_bad("")


def test_seed_words_do_not_fade(frame):
    """A thousand times the running text: the same words and verdicts, also where a seed's parts are common words."""
    text = "we bet w in lo an po rn b et and the news of good words here "
    urls = [f"http://news{i % 3}.org/en/" for i in range(30)]
    urls += [f"http://{w}{i}.org/x" for w in ("winner", "loanhub", "win", "porn", "bet", "casinowin") for i in range(3)]
    results = []
    for times in (1, 1000):
        pages = frame([(i, u, f"<p>{text * times}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
        model = U.learn(pages)
        rows = U.judge(pages, model).collect()
        results.append({r.page_id: (r.verdict, r.words) for r in rows})
    assert results[0] == results[1]
    assert {results[0][i][0] for i in range(30)} == {"allow"}
    for i in range(30, len(urls)):
        assert results[0][i][0] == "block" or urls[i].startswith("http://winner"), urls[i]
    runs = frame([(w,) for w in (*U.SEED_WORDS, "casinowin")], "run string")
    split = {r.run: r.words for r in U.segmented(runs, model.lexicon).collect()}
    assert split.pop("casinowin") == ["casino", "win"]
    assert split == {w: [w] for w in U.SEED_WORDS}


def brute(rows):
    """Verdicts, words and scores of (id, url, html) rows by plain Python over whole tables in memory."""
    counts = Counter(w for _, _, h in rows for w in U._PLAIN_WORD.findall(U.visible(h or "").lower()) if len(w) <= U.LONGEST_WORD)
    share = U.SEED_SHARE * (sum(counts.values()) or 1)
    for w in U.SEED_WORDS:
        counts[w] += share
    segment = U.Segmenter(counts)
    words = {}
    for i, u, _ in rows:
        host, path, *_ = plain(u)
        words[i] = [m + w for m, t in (("h:", host), ("p:", path)) for run in U._LETTERS.findall(t.lower()) for w in segment(run)]
    seeds = {"h:" + w for w in U.SEED_WORDS}
    seen, pages = {True: Counter(), False: Counter()}, Counter()
    for i, _, h in rows:
        if h is not None:
            bad = U.looks_bad(U.visible(h)) or bool(seeds & set(words[i]))
            pages[bad] += 1
            seen[bad].update(words[i])
    every = seen[True].keys() | seen[False].keys()
    total = {k: sum(c.values()) + len(every) + 1 for k, c in seen.items()}
    weight = {w: math.log((seen[True][w] + 1) / total[True]) - math.log((seen[False][w] + 1) / total[False]) for w in every}
    bias = math.log((pages[True] + 1) / (pages[False] + 1))
    out = {}
    for i, u, _ in rows:
        score = bias + sum(weight.get(w, 0.0) for w in words[i])
        out[i] = plain(u)[3] or ("block" if score > 0 else "allow"), " ".join(words[i]), round(score, 6)
    return out


def test_whole_result_against_brute_force(frame):
    rng = random.Random(5)
    vocabulary = ["news", "cheap", "pills", "farm", "weather", "the", "city", "straße", "reise", "new", "s", "pill", "est", "bet", "a"]
    rows = []
    for i in range(300):
        host = "".join(rng.choices(vocabulary, k=rng.randint(1, 4))) + rng.choice([".org", ".net", ".com", "1.de"])
        path = "/" + "/".join("".join(rng.choices(vocabulary, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 3)))
        junk = "%%% a### $$$ " if rng.random() < 0.3 else ""
        html = None if rng.random() < 0.1 else f"<p>{' '.join(rng.choices(vocabulary, k=8))} {junk}</p>"
        rows.append((i, rng.choice(["http://", "https://"]) + host + path, html))
    rows += [(300, None, "<p>the</p>"), (301, "http://hot.org/", ""), (302, "http://" + "cheapx" * 900 + ".org/", None)]
    rows += [(303 + i, "http://www.hotnews.org/en/", "<p>news</p>") for i in range(150)]
    pages = frame([(*r, 7) for r in rows], "page_id long, url string, html string, SCORE int")
    got = {r.page_id: (r.verdict, r.words, round(r.score, 6)) for r in U.judge(pages, U.learn(pages)).collect()}
    assert got == brute(rows)
    assert {v for v, _, _ in got.values()} == {"allow", "block"}
