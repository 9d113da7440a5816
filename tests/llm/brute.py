"""Plain, slow versions of the contracts, from rows to rows."""

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return SPACE.findall((text or "").translate(LOWER))


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def fingerprint(text, width=3):
    words = space_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, radius=3):
    """rows: (doc_id, text). Returns sorted (doc_id, fingerprint, component_id)."""
    fps = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = {}
    for (d, _), f in zip(rows, fps):
        r = root(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", least.get(root(f))) for (d, _), f in zip(rows, fps)]


def decontaminated(docs, bench, width=13):
    windows = defaultdict(set)
    for item, text in bench:
        words = alnum_words(text)
        size = min(width, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, text in docs:
        words = alnum_words(text)
        hit, items = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    items |= found
        names = sorted(str(i) for i in items if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((d, len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def unigram(rows, modulus=5, kept_out=1):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score); one row for each id."""
    counts = Counter()
    for d, t in rows:
        if remainder(d, modulus) != kept_out:
            counts.update([*space_words(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        tokens = [*space_words(t), "\n"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        out.setdefault(d, (remainder(d, modulus) == kept_out, len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    return out


def ruled(url, rules):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [
        (len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule = max(fits, default=(0, None, None))
    return host, path, rule[1], rule[2]


def line_dedup(rows, min_chars=20, min_docs=3):
    """rows: (doc_id, text) -> (doc_id, n_lines, n_dropped, kept text)."""
    holders = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            ids = holders[key(line)] - {None}
            if len(key(line)) < min_chars or len(ids) < min_docs or d == max(ids):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def one_edit_apart(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, min_chars=5, min_count=3, ratio=2, modulus=97):
    """rows: (doc_id, text) -> (word, n, n_near, form, form_n, root)."""
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % modulus == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit_apart(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return out


def token_alignment(rows, file_a, file_b):
    """rows: (doc_id, text) -> (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(file_a), SentencePieceProcessor(model_file=file_b)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
    parsed, counts = [], Counter()
    for d, t in rows:
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [(i, b.id_to_piece(i)) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            parsed.append((d, [], [], [], []))
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            ends = [0]
            for token in tokens:
                ends.append(ends[-1] + len(token))
            spans.append(list(zip(ends, ends[1:])))
        linked, first = [], 0
        for i, (x, y) in enumerate(spans[0]):
            while spans[1][first][1] <= x:
                first += 1
            for j in range(first, len(spans[1])):
                if spans[1][j][0] >= y:
                    break
                linked.append((ids_a[i], ids_b[j]))
        counts.update(linked)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for start, end in zip([0, *cuts], cuts):
            side = []
            for ids, span in zip((ids_a, ids_b), spans):
                near = range(bisect.bisect_left(span, (start, -1)), bisect.bisect_left(span, (end, -1)))
                side.append(",".join(str(ids[i]) for i in near))
            groups.append("|".join(side))
        parsed.append((d, ids_a, ids_b, groups, linked))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (d, len(x), len(y), len(g), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), ";".join(g))
        for d, x, y, g, k in parsed
    ]
