"""Plain versions of the operators, for small inputs."""

import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def shingles(text, width=5):
    words = SPACED.findall(lower(text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_components(rows, percent):
    """Smallest id reachable for every id of (id, text) rows, ids of repeated rows being one document."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    holders = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(k)
    for k, (i, s) in enumerate(sets):
        common = Counter(m for x in s for m in holders[x] if m < k)
        for m, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[m][1]) - n):
                a, b = find(i), find(sets[m][0])
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def quality_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def binomial_below(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def license_row(text, phrases, templates, threshold, span):
    words = ALNUM.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in phrases.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    more, best = set(), 0.0
    lines = [ALNUM.findall(lower(line)) for line in (text or "").split("\n")]
    blocks = [own[i : i + span] for own in lines for i in range(0, max(1, len(own) - span // 2), span // 2)]
    # Windows of the whole text; those within a line are among that line's blocks or parts of them.
    at = [k for k, own in enumerate(lines) for _ in own]
    starts = range(0, max(1, len(words) - span // 2), span // 2)
    blocks += [words[i : i + span] for i in starts if len(set(at[i : i + span])) > 1]
    sets = [(label, set(ALNUM.findall(lower(template)))) for label, template in templates]
    for block in map(set, blocks):
        for label, wanted in sets:
            share = len(wanted & block) / len(wanted)
            if share >= threshold - 1e-9:
                more.add(label)
                best = max(best, share)
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(labels | more)),
        1.0 if places else best,
    )


def markov_score(subject, accepted, rejected, order, characters, start):
    """Mean log-likelihood ratio by counting every context anew."""

    def likelihood(examples):
        counts = defaultdict(Counter)
        for text in examples:
            padded = start * order + text
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    counts[padded[i - k : i]][padded[i]] += 1

        def share(context, c):
            below = share(context[1:], c) if context else 1 / characters
            seen = counts.get(context)
            if not seen:
                return below
            return (seen[c] + len(seen) * below) / (sum(seen.values()) + len(seen))

        return share

    a, r = likelihood(accepted), likelihood(rejected)
    padded = start * order + subject
    ratios = [
        math.log(a(padded[i - order : i], padded[i])) - math.log(r(padded[i - order : i], padded[i]))
        for i in range(order, len(padded))
    ]
    return sum(ratios) / len(ratios)


class Leaves(HTMLParser):
    """Texts of balanced markup, each with its whole path of (name, class) steps."""

    def __init__(self, page: str):
        super().__init__()
        self.open, self.texts = [], []
        self.feed(page)

    def handle_starttag(self, name, attributes):
        self.open.append((name, dict(attributes).get("class", "")))
        self.texts.append(None)

    def handle_endtag(self, name):
        assert self.open.pop()[0] == name
        self.texts.append(None)

    def handle_data(self, text):
        if text.strip():
            self.texts.append((tuple(self.open), text.strip()))


def tag_path_text(page: str, words: dict[str, int], sigma, evidence, against, share, drop, most) -> str:
    """Content by the ratios of tag paths, every sum taken anew; a div's text stands in p and a elements. Words: 1 for, -1 against."""
    texts = [x for x in Leaves(page).texts if x]
    order = list(dict.fromkeys(path for path, _ in texts))
    of = {path: [t for q, t in texts if q == path] for path in order}

    def says(path):
        for name, word in path:
            if words.get(word, 0) < 0:
                return -1
        return int(any(name == "article" or words.get(word, 0) > 0 for name, word in path))

    def plain(path):
        return 0 if any(name == "a" for name, _ in path) else sum(map(len, of[path]))

    def ratio(path):
        marks = sum(t.count(c) for t in of[path] for c in ".,;:!?")
        return math.log(1 + plain(path) / len(of[path]) * (1 + marks / len(of[path])))

    if not any(map(plain, order)):
        return ""
    fair = sum(plain(p) for p in order if says(p) >= 0)
    named = sum(plain(p) for p in order if says(p) > 0) / max(fair, 1)
    score = {}
    for i, path in enumerate(order):
        near = [(math.exp(-0.5 * ((i - j) / sigma) ** 2), ratio(q)) for j, q in enumerate(order) if abs(i - j) <= 3 * sigma]
        smooth = sum(w * r for w, r in near) / sum(w for w, _ in near)
        names = evidence * min(1, 2 * named) if says(path) > 0 else against * min(says(path), 0)
        score[path] = max(smooth, ratio(path)) + names
    mass = {p: plain(p) * (0.25 if says(p) < 0 else 1) for p in order}
    top = max(s for s in score.values() if sum(m for p, m in mass.items() if score[p] >= s) >= share * sum(mass.values()))
    chosen = {p for p in order if score[p] > max(top - drop, 0) and (plain(p) or says(p) > 0)}
    total = sum(map(plain, chosen))
    heads = sorted({p[:k] for p in chosen for k in range(len(p) + 1)}, key=len)
    inner = [h for h in heads if sum(plain(p) for p in chosen if p[: len(h)] == h) >= most * total][-1] if chosen else ()
    while inner and inner[-1][0] in ("p", "h1", "li"):
        inner = inner[:-1]
    if chosen:
        chosen |= {p for p in order if p[: len(inner)] == inner and says(p) >= 0 and (plain(p) or says(p) > 0)}
    return "\n\n".join(t for p, t in texts if p in chosen)
