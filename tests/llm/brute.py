"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACES = " \t\n\x0b\f\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def shingles(text, n):
    w = words((text or "").translate(UPPER))
    return [" ".join(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)] if w else []


def fingerprint(text, n):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_of_groups(ids, linked):
    """id -> smallest id reachable, by union of all linked pairs."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash_groups(docs, n=3):
    prints = {i: fingerprint(t, n) for i, t in docs}
    ids = sorted(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    return prints, smallest_of_groups(ids, linked)


def line_key(line):
    return line.strip(SPACES).translate(UPPER)


def without_repeated_lines(docs):
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(i)
    out = {}
    for i, t in docs:
        out[i] = "\n".join(x for x in (t or "").split("\n") if min(holders.get(line_key(x), {i})) == i)
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_spans(text):
    out = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


SECRET = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "github": r"gh[pousr]_[A-Za-z0-9]+",
    "slack": r"xox[baprs]-[A-Za-z0-9-]+",
    "google": r"AIza[A-Za-z0-9_-]+",
    "stripe": r"[rs]k_live_[A-Za-z0-9]+",
    "private_key": r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----",
}
SECRET_LENGTH = {"access": 18, "hex": 16, "github": 40, "slack": 20, "google": 39, "stripe": 24, "private_key": 1}


def secret_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(SECRET.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(1)) >= 12 if kind == "assign" else len(m.group()) >= SECRET_LENGTH[kind]:
                out.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def bare(text):
    return [w for w in ("".join(c for c in x.lower() if c.isalnum()) for x in (text or "").split()) if w]


def leaks(docs, items):
    """(doc, item) pairs that leak, every item held against every document."""

    def sets(w):
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    out = set()
    for item, text in items:
        question, _, answer = (text or "").strip().rpartition("\n")
        q, a = bare(question or answer), bare(answer) if question else []
        if not q:
            continue
        for doc, body in docs:
            w = bare(body)
            held = {tuple(w[i : i + n]) for n in {min(len(q), 5), min(len(a), 5)} - {0} for i in range(len(w) - n + 1)}
            got_q, got_a = len(sets(q) & held), len(sets(a) & held)
            whole = got_q + got_a >= 0.8 * (len(sets(q)) + len(sets(a)))
            if whole or (len(q) >= 8 and got_q >= 0.8 * len(sets(q))):
                out.add((doc, item))
    return out


def line_fails(line):
    """One line, stripped, by the three rules of the quality operator."""
    if not line:
        return False
    n = len(words(line))
    menu = r"(?i)\b(home|login|log in|sign in|sign up|menu|sitemap|next|previous|back to top|share|subscribe)\b"
    stock = (
        r"(?i)(all rights reserved|accept (all )?cookies|we use cookies|privacy policy|terms of (use|service)"
        r"|enable javascript|click here|subscribe to our newsletter|lorem ipsum|follow us on|powered by)"
    )
    navigation = sum(line.count(c) for c in "|»›•·") >= 3 or (n <= 4 and re.search(menu, line))
    punctuation = (
        sum(line.count(c) for c in "#*$%&|<>") * 10 > len(line)
        or ("!!" in line and line.count("!!") * 4 >= n)
        or (n < 4 and not re.search(r"[.!?…。！？:;][\"'”’»)\]]*$", line))
    )
    return bool(navigation or punctuation or (n <= 30 and re.search(stock, line)))


def cleaned(text):
    """The text without failing lines, or None where the document is rejected."""
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    if len(w) < 20 or 100 * len(covered) > 30 * len(w):
        return None
    left = "\n".join(x for x in (text or "").split("\n") if not line_fails(x.strip(SPACES)))
    return left if 100 * sum(map(len, words(left))) >= 50 * sum(map(len, w)) else None


def mix(docs):
    """doc -> taken words, for (doc, source, text) rows."""
    sizes = {d: len(words(t)) for d, _, t in docs}
    of = defaultdict(int)
    for d, s, _ in docs:
        of[s] += sizes[d]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        level = (1.5 * sum(of.values()) - sum(target.values())) / max(sum(weight[s] for s in free), 1)
        over = {s for s in free if weight[s] * level > 2 * of[s]}
        if not over:
            break
        target |= {s: 2.0 * of[s] for s in over}
        free -= over
    target |= {s: weight[s] * level for s in free}
    taken, ahead = {}, Counter()

    def key(row):
        d, _, t = row
        t = t or ""
        seed = hashlib.md5(f"{'null' if d is None else d}/{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
        u = (int(seed[:12], 16) + 0.5) / 2**48
        return -math.log(u) * (1 + 20 * sum(t.count(c) for c in "#*$%&|<>") / max(len(t), 1))

    for d, s, t in sorted(docs, key=key):
        epochs = int(target[s] // of[s]) if of[s] else 0
        rest = math.floor(target[s]) - epochs * of[s]
        taken[d] = epochs * sizes[d] + max(0, min(sizes[d], rest - ahead[s]))
        ahead[s] += sizes[d]
    return taken, target, of


def hard_negatives(rows, k=5, low=80, high=100):
    """(anchor, positive, rank, negative, scores) of (id, label, vector) rows; anchors are ids divisible by 100."""

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    found = []
    for anchor, label, vector in rows:
        if anchor % 100:
            continue
        scored = sorted((-score(vector, v), i, own == label) for i, own, v in rows if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2]][:k]:
            fits = [s for s in scored if not s[2] and -low * minus <= -100 * s[0] <= -high * minus][:k]
            found += [(anchor, positive, n, i, -minus, -s) for n, (s, i, _) in enumerate(fits, 1)]
    return sorted(found)


def aligned_tokens(rows, folder):
    """The digest rows of two tokenizers by plain loops over tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
    signs, free = {}, 256
    for byte in range(256):
        shown = 33 <= byte < 127 or 161 <= byte < 173 or byte >= 174
        signs[chr(byte if shown else free)] = byte
        free += not shown
    a_bytes = {i: w.encode() if w == "<|endoftext|>" else bytes(signs[c] for c in w) for w, i in a_side.get_vocab().items()}

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("\u2581", " ").encode()

    counts, docs = Counter(), []
    for doc_id, text in rows:
        docs.append((doc_id, None))
        if not text:
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        plain = (" " + text).encode()
        if b"".join(a_bytes[i] for i in a) != plain or b"".join(map(b_bytes, b)) != plain:
            continue
        groups, left, right, end_a, end_b = [], [], [], 0, 0
        rest_a, rest_b = list(reversed(a)), list(reversed(b))
        while rest_a or rest_b:
            if end_a <= end_b and rest_a:
                left.append(rest_a.pop())
                end_a += len(a_bytes[left[-1]])
            else:
                right.append(rest_b.pop())
                end_b += len(b_bytes(right[-1]))
            if end_a == end_b:
                groups.append((left, right))
                left, right = [], []
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        counts.update(links.keys())
        docs[-1] = doc_id, (len(a), len(b), groups, links)
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    found = []
    for doc_id, entry in docs:
        if entry is None:
            found.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = entry
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        top = sum(n for pair, n in links.items() if counts[pair] == best[pair[0]])
        total = sum(n * counts[pair] for pair, n in links.items())
        digest = hashlib.sha256(text.encode()).hexdigest()
        found.append((doc_id, n_a, n_b, len(groups), sum(links.values()), top, total, digest))
    return found
