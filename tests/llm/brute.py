"""Plain versions of the operators for small inputs."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components(rows):
    """Row number to the numbers of all rows that links reach."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return {i: members for members in groups.values() for i in members}, sets


def repeated_bytes(rows, match=50):
    """For each row a list of flags, one per byte."""
    first, out = {}, []
    smallest = lambda i: -(1 << 63) if i is None else i
    for doc, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - match + 1):
            gram = data[s:s + match]
            first[gram] = min(first.get(gram, 1 << 63), smallest(doc))
    for doc, text in rows:
        data, gone = (text or "").encode(), [False] * len((text or "").encode())
        for s in range(len(data) - match + 1):
            if first[data[s:s + match]] < smallest(doc):
                gone[s:s + match] = [True] * match
        out.append(gone)
    return out


def repeat_row(text, gone):
    data = (text or "").encode()
    runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
    kept = bytes(b for b, g in zip(data, gone) if not g)
    return len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def cut_characters(text, gone):
    """The text without the characters all of whose bytes are to go."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not all(gone[at:at + n]):
            out.append(c)
        at += n
    return "".join(out)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def least_edits(passage, text):
    """Edits between the passage and the closest part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(passage, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.sub(r"[\t-\r \xa0]+", " ", text)


def judge_url(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = re.split(r"[?#]", rest[end:])[0]
    fits = [(len(h + p), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[1] if best else default
