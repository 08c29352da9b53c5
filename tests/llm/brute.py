"""Plain re-statements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remainder(doc_id, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def shingles(text: str | None, n: int) -> set:
    own = words(fold(text))
    if len(own) >= n:
        return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
    return {tuple(own)} if own else set()


def near_duplicates(rows, n: int = 4) -> dict:
    """doc_id -> (n_shingles, component_id)"""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    met = Counter()
    lists = defaultdict(list)
    for i, s in sorted(sets.items()):
        for item in s:
            met.update((j, i) for j in lists[item])
            lists[item].append(i)
    for (a, b), common in met.items():
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def substrings(rows, window: int = 13) -> dict:
    """doc_id -> (n_words, n_removed, kept_sha256)"""
    texts = {i: words(t) for i, t in rows}
    first: dict = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - window + 1):
            first.setdefault(tuple(texts[i][k : k + window]), i)
    out = {}
    for i, own in texts.items():
        gone = set()
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out[i] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    own = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    covered = {j for i in range(len(own) - 7) if seen[tuple(own[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(own) < 20 or 100 * len(covered) > 30 * len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered), failed


def repeated_shares(text: str | None, lengths) -> dict[int, float]:
    """Share of word characters in n-grams that are not the first of their kind."""
    own = words(text)
    total = max(1, sum(map(len, own)))
    out = {}
    for n in lengths:
        seen, covered = set(), set()
        for i in range(len(own) - n + 1):
            gram = tuple(own[i : i + n])
            if gram in seen:
                covered.update(range(i, i + n))
            seen.add(gram)
        out[n] = sum(len(own[j]) for j in covered) / total
    return out


def ngram_scores(rows, trains, discount: float = 0.75) -> dict:
    """doc_id -> (n_tokens, n_known, train_tokens, base_score, score), without quantisation"""
    tokens = {i: words(fold(t)) + ["</s>"] for i, t in rows}
    count, pairs, starts = Counter(), Counter(), 0
    for i, own in tokens.items():
        if trains(i):
            starts += 1
            count.update(own)
            pairs.update(zip(["<s>"] + own[:-1], own))
    total, kinds = sum(count.values()), len(count)
    followers = Counter(a for a, _ in pairs)
    out = {}
    for i, own in tokens.items():
        base = score = 0.0
        for a, b in zip(["<s>"] + own[:-1], own):
            p = (count[b] + 0.5) / (total + 0.5 * (kinds + 1))
            c = starts if a == "<s>" else count[a]
            base += math.log10(p)
            mine = (pairs[a, b] - discount) / c if pairs[a, b] else 0.0
            score += math.log10(mine + (discount * followers[a] / c if c else 1.0) * p)
        out[i] = (len(own), sum(count[w] > 0 for w in own), total, base, score)
    return out


def fingerprint(text: str | None, n: int = 3) -> int:
    own = words(fold(text))
    grams = [own[i : i + n] for i in range(len(own) - n + 1)] or ([own] if own else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_within(prints, distance: int) -> dict:
    """print -> the least print reachable over links of at most `distance` bits"""
    prints = sorted(set(prints))
    label = {x: x for x in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def collocations(rows, least: int = 30, longest: int = 4, top: int = 2000) -> list:
    """rows (lang, text) -> (lang, rank, phrase, a, l, r, n, score)"""
    count, size = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(own)
            for m in range(1, longest + 1):
                count.update((lang, tuple(own[i : i + m])) for i in range(len(own) - m + 1))
    found = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i : i + m]] = max(longer[lang, w[i : i + m]], a)
    by_lang = defaultdict(list)
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (count[lang, w[:k]] + count[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, size[lang], -score)
        for lang, own in by_lang.items() for i, (score, a, p, l, r) in enumerate(sorted(own)[:top])
    )


def trie(rows, group: int = 20) -> list:
    """rows (conv_id, turn, role, text) -> the contract's columns in order"""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), Counter()
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - math.copysign(abs(c) % group, c)
        s = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    kids.update(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        x = (len(m) - 1) * len(words(s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += x
            leaves[s[:d]] += not kids[s]
    return sorted(
        (m[0], len(s), members[s[:-1]][0] if s else None, len(m), kids[s], leaves[s], saved[s],
         hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest()) for s, m in list(members.items())
    )
