"""The operators' results the plain way, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import regex
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text: str | None) -> int:
    words = SPACE.findall(lower_ascii(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def united(n: int, links: list[tuple[int, int]]) -> list[int]:
    """For each place the smallest place it reaches."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash_links(fingerprints: list[int]) -> list[tuple[int, int]]:
    fps = np.array(fingerprints, dtype=np.uint64)
    return [
        (i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= 4) + i + 1
    ]


def simhash_groups(rows: dict[int, str | None]) -> dict[int, int]:
    ids = sorted(rows)
    roots = united(len(ids), simhash_links([simhash(rows[i]) for i in ids]))
    return {i: ids[r] for i, r in zip(ids, roots)}


def rule_statistics(text: str | None) -> dict[str, int]:
    text = text or ""
    words = SPACE.findall(text)
    lines = [line for line in text.split("\n") if SPACE.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts: dict = {}
    for window in windows:
        counts[window] = counts.get(window, 0) + 1
    covered = {i + k for i, window in enumerate(windows) if counts[window] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(text.count, "#*$%&|<>")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def crc32_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def held_out(key: int, modulus: int, remainder: int) -> bool:
    return zlib.crc32(str(key).encode()) % modulus == remainder


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(rows: dict[int, str | None]) -> dict[int, tuple]:
    """Payload size, digest, type and what is referred to, by page."""
    first: dict[bytes, int] = {}
    found = {}
    for page in sorted(rows):
        data = (rows[page] or "").encode()
        response = first.setdefault(data, page)
        kind = "response" if response == page else "revisit"
        found[page] = (len(data), base32_sha1(data), kind, None if kind == "response" else response)
    return found


def vector_links(vectors: list) -> list[tuple[int, int]]:
    found = []
    for i, a in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            b = vectors[j]
            if not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                found.append((i, j))
    return found


def usable(vector) -> bool:
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def auc(scores, labels) -> float:
    """Chance that a row with label 1 scores above one with label 0."""
    scores, labels = np.asarray(scores), np.asarray(labels)
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values, inverse, counts = np.unique(scores[order], return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    ranks[order] = (ends - (counts - 1) / 2)[inverse]
    n = labels.sum()
    return float((ranks[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n)))


# Conversations, phrases and passages

def conversation(turns: list[tuple[int | None, str | None, str | None]]) -> dict:
    """What op11 says of one conversation's turns (number, role, text), in input order."""
    turns = sorted(((n, r if r is not None else " ", t if t is not None else " ") for n, r, t in turns), key=lambda x: (x[0] is not None, x[0] or 0))
    faults, seen = [], set()
    for _, role, text in turns:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None)
        seen.add((role, text))
    # Cheapest way to every state of the grammar after every turn, inserts relaxed until nothing changes.
    after = {("0", "u"): "u", ("0", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"0": (0, "")}
    for i in range(len(turns) + 1):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for letter in "ua":
                    to = after.get((state, letter))
                    if to and (to not in best or (cost + 2, audit + "I") < best[to]):
                        best[to] = cost + 2, audit + "I"
        if i == len(turns):
            break
        moved: dict[str, tuple[int, str]] = {}
        for state, (cost, audit) in best.items():
            ways = [(state, cost + 3, "D")]
            if faults[i] not in ("blank", "duplicate"):
                extra = 1 if faults[i] == "truncated" else 0
                initial = turns[i][1][:1]
                if (state, initial) in after:
                    ways.append((after[state, initial], cost + extra, "K"))
                ways += [(after[state, x], cost + extra + 2, "R") for x in "ua" if (state, x) in after and x != initial]
            for to, total, letter in ways:
                if to not in moved or (total, audit + letter) < moved[to]:
                    moved[to] = total, audit + letter
        best = moved
    cost, audit = min(best[s] for s in ("0", "a") if s in best)
    numbers = [n for n, _, _ in turns if n is not None]
    lines, state, waiting = [], "0", iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(waiting)[1:]
        if edit == "D":
            continue
        if edit in "IR":
            role = "assistant" if state == "u" else "user"
        state = role[:1]
        lines.append(f"{role}:{text}")
    pairs = zip(turns, turns[1:])
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **{fault: faults.count(fault) for fault in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def damaged_turns(rows: list[tuple]) -> dict:
    """op11's damage: conversation to its turns (number, role, text) in input order."""
    found: dict = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        mine = found.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        mine += [(turn, role, text)] * (2 if fate == 3 else 1)
    return found


def collocations(rows: list[tuple[str | None, str | None]], support: int, top: int) -> list[tuple]:
    """op12's rows for (lang, text)."""
    counts: dict[str, dict[tuple, int]] = {}
    for lang, text in rows:
        mine = counts.setdefault(lang or "und" if lang is None else lang, {})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    key = tuple(words[i : i + size])
                    mine[key] = mine.get(key, 0) + 1
    out = []
    for lang, mine in counts.items():
        n = sum(f for phrase, f in mine.items() if len(phrase) == 1)
        wanted = {p: f for p, f in mine.items() if len(p) > 1 and f >= support}
        inner: dict[tuple, int] = {}
        for phrase, f in wanted.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    key = phrase[i : i + size]
                    inner[key] = max(inner.get(key, 0), f)
        kept = []
        for p, a in wanted.items():
            if inner.get(p, 0) >= a:
                continue
            score, k = min((1000 * a * n // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return _TERM.findall(lower_ascii(text or ""))


def contamination(docs: list[tuple], items: list[tuple], width: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, sorted item ids) of every document."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = terms(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in docs:
        w = terms(text)
        hit, named = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    named |= {str(x) for x in found if x is not None}
        out.append((doc, len(w), len(hit), sorted(named)))
    return out


def language_scores(rows: list[tuple], texts: list[str | None], words_kept: int, grams_kept: int, smoothing: float, most_against: float) -> list[tuple]:
    """op9's language and score of each text, from training rows (id, lang, text) that all fit in the sample."""
    chosen: dict[tuple, str] = {}
    for key, lang, text in rows:
        if None in (key, lang, text):
            continue
        best = chosen.get((key, lang))
        if best is None or np.int64(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64)) < np.int64(np.uint64(xxhash.xxh64_intdigest(best.encode(), 42)).view(np.int64)):
            chosen[key, lang] = text
    languages = sorted({lang for _, lang in chosen})
    words: dict[str, dict[str, int]] = {lang: {} for lang in languages}
    grams: dict[str, dict[str, int]] = {lang: {} for lang in languages}
    for (_, lang), text in chosen.items():
        for word in regex.findall(r"\p{L}+", text.lower()):
            words[lang][word] = words[lang].get(word, 0) + 1
    languages = [lang for lang in languages if words[lang]]
    for lang in languages:
        for word, n in words[lang].items():
            marked = f"<{word}>"
            for size in range(1, 6):
                for i in range(len(marked) - size + 1):
                    gram = marked[i : i + size]
                    if gram not in "<>":
                        grams[lang][gram] = grams[lang].get(gram, 0) + n

    def logs(counts, bound, least):
        kept = {item for lang in languages for item in [x for x, _ in sorted(((x, n) for x, n in counts[lang].items() if n >= least), key=lambda p: (-p[1], p[0].encode()))[:bound]]}
        sums = [sum(counts[lang].values()) + smoothing * len(kept) for lang in languages]
        return {item: [math.log((counts[lang].get(item, 0) + smoothing) / total) for lang, total in zip(languages, sums)] for item in kept}

    known, pieces = logs(words, words_kept, 2), logs(grams, grams_kept, 1)
    out = []
    for text in texts:
        found = regex.findall(r"\p{L}+", (text or "").lower())
        total = [0.0] * len(languages)
        for word in found:
            scores = known.get(word)
            for size in range(min(5, len(word) + 2), 0, -1) if scores is None else ():
                within = f"<{word}>" if size > 1 else word
                hits = [pieces[within[i : i + size]] for i in range(len(within) - size + 1) if within[i : i + size] in pieces]
                if hits:
                    scores = [sum(column) / len(hits) for column in zip(*hits)]
                    break
            if scores:
                total = [t + max(s - max(scores), -most_against) for t, s in zip(total, scores)]
        if not found or not languages:
            out.append(("und", 0.0))
            continue
        best = total.index(max(total))
        odds = [math.exp((t - total[best]) / math.sqrt(len(found))) for t in total]
        out.append((languages[best], odds[best] / sum(odds)))
    return out
