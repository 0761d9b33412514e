"""Brute-force versions and edge tables for the operators' tests."""

import re
from collections import Counter, defaultdict

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "score double, kept string, node string, bucket string, label string, Text_key string")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n):
    import random

    rng = random.Random(seed)
    syllables = ["an", "er", "tion", "sh", "lo", "ma", "ké", "ru", "th", "in", "ou", "be"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def edge_rows():
    """(doc_id, text, lang, source) rows with every awkward case."""
    long = "\n".join(prose(1000 + i, 60) for i in range(400))
    base = prose(1, 300)
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", "b"), (3, " ".join(near), "en", "b"),
        (4, None, "en", "a"), (5, "", "de", "b"), (6, "   \n\t ", None, None), (7, "one", "en", None),
        (8, "One two\nthree", None, "a"), (None, prose(2, 80), "en", "a"), (None, None, None, None),
        (9, long, "fr", "a"), (10, "日本語のテキスト" * 40, "ja", "c"), (11, "a\x00b  c <|endoftext|> d's", "en", "a"),
        (12, prose(3, 50) + "\n" + prose(4, 50), "en", "a"), (13, prose(3, 50).upper() + "\n" + prose(5, 50), "en", "a"),
    ]
    return [r + (len(r[1] or ""), 0.5, "x", "y", "z", "w", "v") for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def shingles(text, n=5):
    w = WORD.findall(lower_ascii(text))
    if len(w) >= n:
        return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_components(rows, percent=85):
    """{doc_id: (set size, component)} by all pairs; rows are (doc_id, text)."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        common = Counter(e for x in s for e in holders[x] if e > d)
        for e, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def benchmark_hits(text, items, n=10):
    """(n_words, n_hit, item ids) of a text against (item_id, text) items."""
    windows = defaultdict(set)
    for i, t in items:
        w = BENCH_WORD.findall(lower_ascii(t))
        size = min(n, len(w))
        for k in range(len(w) - size + 1) if size else ():
            windows[tuple(w[k:k + size])].add(i)
    words = BENCH_WORD.findall(lower_ascii(text))
    hit, found = set(), set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            ids = windows.get(tuple(words[k:k + size]))
            if ids:
                found |= ids
                hit |= set(range(k, k + size))
    return len(words), len(hit), found


def base_stats(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    n, repeat = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
            n < 20 or 100 * repeat > 30 * n)


def line_shingles(line, chars=9):
    norm = re.sub(r"\s+", " ", line.lower()).strip()
    out = set()
    for i, c in enumerate(norm):
        run = norm[max(0, i - chars + 1):i]
        if c != " " and (i == 0 or norm[i - 1] == " " or (len(run) == chars - 1 and " " not in run)):
            out.add(norm[i:i + chars])
    return norm, frozenset(out)


def removed_lines(rows, percent=80):
    """{(doc_id, position)} that fuzzy line dedup removes, by all pairs."""
    at = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            norm, s = line_shingles(line)
            if norm:
                at.setdefault(norm, (s, []))[1].append((d, k))
    keys = list(at)
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            sa, sb = at[a][0], at[b][0]
            k = len(sa & sb)
            if 100 * k >= percent * (len(sa) + len(sb) - k):
                parent[find(b)] = find(a)
    groups = defaultdict(list)
    for k in keys:
        groups[find(k)] += at[k][1]
    return {p for g in groups.values() for p in g if p != min(g)}
