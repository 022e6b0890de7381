import random
import re
from collections import defaultdict

from wordlake.llm.common import components
from wordlake.llm.near_dedup import drop_near_copies, near_duplicates


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\\x20\\x09-\\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets, up = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates(spark):
    r = random.Random(4)
    texts = [None, "", "  \n", "one two", "ONE  Two", "one two three", "a b c d e", "A b c d e", "é É", "é é"]
    for size, edits in ((30, 1), (60, 2), (200, 6), (100, 9)):
        base = [f"v{r.randrange(10**6)}" for _ in range(size)]
        texts += [edited(r, base, r.randint(0, edits)) for _ in range(25)]
    hot = [f"h{r.randrange(10**6)}" for _ in range(120)]
    texts += [edited(r, hot, r.randint(0, 8)) for _ in range(150)] + [edited(r, hot, 0)] * 30
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    r.shuffle(rows)
    table = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, node int, key string")
    got = {x["doc_id"]: x for x in near_duplicates(table).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for i, (n, c) in want.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i)
    kept = drop_near_copies(table)
    assert kept.columns == table.columns and kept.count() == sum(c == i for i, (_, c) in want.items())
    assert near_duplicates(table.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = defaultdict(int) | {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == dict(want)
