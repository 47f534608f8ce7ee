"""Awkward documents, and plain versions of the operators."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, extra=""):
    """Rows (id, text) as a documents table; ``extra`` names more columns, all strings."""
    names = [n for n in extra.split() if n]
    rows = [(i, t, "en", "src0", len(t or ""), *("x" for _ in names)) for i, t in texts]
    schema = DOCUMENT + "".join(f", {n} string" for n in names)
    return spark.createDataFrame(rows, schema)


def prose(seed, n):
    made = random.Random(seed)
    return " ".join(f"w{made.randrange(5000)}" for _ in range(n))


def awkward():
    """Nulls, empty and blank texts, repeated rows, ties, copies, overlaps and a long text."""
    base = prose(1, 80).split()
    near = [*base]
    near[40] = "Other"
    license_lines = "\n".join(prose(s, 9) for s in range(90, 95))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, " ".join(base)),
        (4, " ".join(base)),
        (5, " ".join(near).upper()),
        (6, " ".join(base[10:50]) + "\n" + prose(7, 30)),
        (7, "one two three"),
        (8, "one  two\tthree"),
        (9, prose(9, 40) + "\n" + license_lines + "\n\n" + prose(10, 12)),
        (10, license_lines + "\n" + prose(11, 30) + "\n" + license_lines),
        (None, " ".join(base)),
        (None, None),
        (11, prose(12, 30_000)),
        (12, "a" * 300_000),
        (13, "é́x\x1fy z İstanbul Σας " * 4),
        (14, "same " * 60),
        (15, prose(13, 12) + " " + "same " * 20),
        (16, "\n".join(["line one two"] * 9)),
    ]


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def after(id_):
    return (id_ is None, id_ or 0)


def without_repeats(rows, size=13):
    first = {}
    for id_, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, after(id_)), after(id_))
    out = []
    for id_, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < after(id_):
                gone |= set(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((id_, len(w), len(gone), " ".join(kept)))
    return out


def shingles(text, size=5):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = words(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def near_groups(rows):
    """Component and kept by comparing all pairs; a null id links by equal sets only."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def join(a, b):
        old, new = label[a], label[b]
        for i, x in enumerate(label):
            if x == old:
                label[i] = new

    for a in range(len(rows)):
        for b in range(a):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both and 100 * both >= 75 * either:
                join(a, b)
    out = []
    for i, (id_, _) in enumerate(rows):
        if sets[i]:
            ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i]]
            component = min((x for x in ids if x is not None), default=None)
        else:
            component = id_
        out.append((id_, len(sets[i]), component, id_ == component))
    return out


def base_statistics(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    marked = set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            marked |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    chars = sum(map(len, w))
    return len(w), chars, symbols, len(lines) - len(set(lines)), len(marked)


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in FORMATS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": kind != "card" or 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def without_lines(rows, run=3):
    """Texts after line dedup; a repeated row is one place."""
    first, places = {}, {}
    for id_, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if words(x)]
        for n in range(len(at) - run + 1):
            key = tuple(lines[i] for i in at[n : n + run])
            place = (*after(id_), text, n)
            places.setdefault((id_, text), []).append((key, n))
            first[key] = min(first.get(key, place), place)
    out = []
    for id_, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if words(x)]
        gone = set()
        for key, n in places.get((id_, text), []):
            if first[key] < (*after(id_), text, n):
                gone |= set(at[n : n + run])
        kept = text if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((id_, kept, len(at), len(gone)))
    return out


def without_lines_by_length(rows, run=3, least_chars=20):
    """Texts after line dedup where fewer long lines are a run too; all runs are compared."""
    first, places = {}, {}
    for id_, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if words(x)]
        for n in range(len(at)):
            for size in range(1, len(at) - n + 1):
                key = tuple(lines[i] for i in at[n : n + size])
                if size < run and sum(len("".join(words(x))) for x in key) < least_chars:
                    continue
                if size > run + 2:
                    break
                place = (*after(id_), text, n)
                places.setdefault((id_, text), set()).add((key, n))
                first[key] = min(first.get(key, place), place)
    out = []
    for id_, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if words(x)]
        gone = set()
        for key, n in places.get((id_, text), ()):
            if first[key] < (*after(id_), text, n):
                gone |= set(at[n : n + len(key)])
        kept = text if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((id_, kept, len(at), len(gone)))
    return out


def as_tuples(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)



TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def contaminated(rows, items, size=10):
    """Words in windows of items, by comparing every window of every text."""
    windows = {}
    for item, text in items:
        w = TOKEN.findall(lowered(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for id_, text in rows:
        w, hit, found = TOKEN.findall(lowered(text)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                held = windows.get(tuple(w[i : i + n]))
                if held:
                    hit |= set(range(i, i + n))
                    found |= held
        names = ",".join(sorted(found))
        out.append((id_, len(w), len(hit), len(found), sha(names), bool(hit)))
    return out


def near_places(rows, items, within):
    """Places of words of an item that have all its other words at hand, as sets by document."""
    out = []
    for id_, text in rows:
        w = TOKEN.findall(lowered(text))
        for item, wanted in items:
            words_ = set(TOKEN.findall(lowered(wanted)))
            for i, x in enumerate(w):
                around = w[max(0, i - within) : i + within + 1]
                if words_ and x in words_ and words_ <= set(around):
                    out.append((id_, item, x, i))
    return out


def near(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts, times=5):
    """word, form, root, n, n_near, form_n by comparing all pairs of words."""
    form, out = {}, {}
    for a, n in counts.items():
        beside = [b for b in counts if near(a, b)]
        best = min(beside, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= times * n else None
        out[a] = len(beside)
    rows = []
    for a, n in counts.items():
        root = a
        while form[root] is not None:
            root = form[root]
        rows.append((a, form[a], root, n, out[a], counts.get(form[a])))
    return rows


def spelled(rows):
    """Words with the letters that a check sum leaves out, and their counts."""
    counts = Counter()
    for id_, text in rows:
        for run in RUN.findall(text or ""):
            low = lowered(run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return counts


def importance(rows, target, percent=25, least=20):
    """n_features, weight, score and rank by plain sums."""

    def features(text):
        w = TOKEN.findall(lowered(text))
        return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    def buckets(found):
        return Counter(zlib.crc32(f.encode()) % 10000 for f in found)

    made = [(id_, *features(text)) for id_, text in rows]
    s, t = Counter(), Counter()
    for _, _, found in made:
        s += buckets(found)
    for text in target:
        t += buckets(features(text)[1])
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    scored = []
    for id_, n, found in made:
        total = sum(
            c * math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
            for b, c in buckets(found).items()
        )
        weight = total // len(found) if found else 0
        h = int(sha(f"7:{'' if id_ is None else id_}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append([id_, len(found), weight, score, n >= least])
    wanted = [x for x in scored if x[4]]
    wanted.sort(key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    drawn = len(wanted) * percent // 100
    ranked = [(*x[:4], i + 1 if i < drawn else None) for i, x in enumerate(wanted)]
    return ranked + [(*x[:4], None) for x in scored if not x[4]]
