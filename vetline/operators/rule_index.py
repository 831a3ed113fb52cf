"""Many scoring rules in one pass over a text.

Most patterns hold a piece of plain text that every match must contain.  All
these pieces are looked for at once, by one regex that is their prefix tree; a
rule whose piece is found is a candidate, and only candidates are matched
with their own pattern (not even these, where the pattern is the piece).
Pieces lead to their rules through a constant table by hash, so the work per
text follows the pieces found in it, not the count of rules.  Rules
without such a piece are matched each.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FEW = 64                # rules up to which each is simply matched
LEAST_PIECE = 2         # code points of a piece

_META = set(".^$*+?{}[]()\\|")
_HIT = "pos int, rule_id int, kind string, pattern string, weight int, whole boolean"
HIT = "struct<rule_id:int,kind:string,pattern:string,weight:int>"


def required_piece(pattern: str) -> tuple[str, bool, bool] | None:
    """``(piece, ignoring ASCII case, the pattern is the piece)`` of a Java
    regex: the longest plain text that each of its matches holds; None where
    there is none, or the pattern has groups or alternatives and it is not known."""
    fold = pattern.startswith("(?i)")
    body = pattern[4:] if fold else pattern
    if fold and not body.isascii():
        return None
    runs, now, i = [], "", 0
    while i < len(body):
        ch = body[i]
        plain = ch not in _META
        if ch in "()|":
            return None
        if ch == "[":
            end = body.find("]", i + 2)
            if end < 0 or "[" in body[i + 1:end] or "\\" in body[i:end]:
                return None
            i = end + 1
        elif ch == "\\":
            if i + 1 == len(body) or body[i + 1] in "QEpPxukcN0123456789":
                return None
            ch, plain = body[i + 1], not body[i + 1].isalnum()
            i += 2
        else:
            i += 1
        many = body[i] if i < len(body) and body[i] in "*+?{" else ""
        if many:
            if plain and many == "+":       # once at least
                now += ch
            runs.append(now)
            now = ""
            if many == "{":
                end = body.find("}", i)
                if end < 0:
                    return None
                i = end
            i += 1
            if i < len(body) and body[i] in "?+":       # lazy or possessive
                i += 1
        elif plain:
            now += ch
        else:
            runs.append(now)
            now = ""
    piece = max([*runs, now], key=len)
    if len(piece) < LEAST_PIECE:
        return None
    return (piece.lower() if fold else piece), fold, not fold and piece == body


def _quoted(ch: str) -> str:
    return "\\" + ch if ch in _META or ch in "-&~#/ " else ch


def prefix_tree(pieces: Sequence[str]) -> str:
    """A regex that matches the longest of the pieces at a place."""
    root: dict = {}
    for p in pieces:
        node = root
        for ch in p:
            node = node.setdefault(ch, {})
        node[""] = {}

    def regex(node: dict) -> str:
        below = [_quoted(ch) + regex(n) for ch, n in sorted(node.items()) if ch]
        if not below:
            return ""
        if len(below) == 1 and "" not in node:
            return below[0]
        return f"(?:{'|'.join(below)})" + ("?" if "" in node else "")
    return regex(root)


def _candidates(text: Column, rules: list[tuple]) -> Column:
    """The rules, as structs, whose piece is in the text; ``(pos, rule, piece, whole)``."""
    by_piece: dict[str, list] = {}
    for pos, r, piece, whole in rules:
        by_piece.setdefault(piece, []).append({"pos": pos, "rule_id": r.rule_id, "kind": r.kind, "pattern": r.pattern, "weight": r.weight, "whole": whole})
    size = 1 << max(1, 2 * len(by_piece) - 1).bit_length()
    table: list[list] = [[] for _ in range(size)]
    for p in by_piece:
        # the longest piece at a place stands for those it begins with
        hits = [h for k in range(LEAST_PIECE, len(p) + 1) for h in by_piece.get(p[:k], [])]
        table[zlib.crc32(p.encode()) % size].append({"piece": p, "hits": hits})
    known = F.from_json(F.lit(json.dumps(table)), f"array<array<struct<piece:string,hits:array<struct<{_HIT.replace(' int', ':int').replace(' string', ':string').replace(' boolean', ':boolean')}>>>>>")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({prefix_tree(sorted(by_piece))}))"), F.lit(1)))
    of = F.transform(found, lambda p: F.flatten(F.transform(F.filter(
        F.get(known, F.pmod(F.crc32(p.cast("binary")), F.lit(size)).cast("int")), lambda e: e["piece"] == p), lambda e: e["hits"])))
    return F.flatten(of)


def matched_rules(rules: Sequence, text: Column, few: int = FEW) -> Column:
    """The rules that match a text, in their order, as an array of
    ``struct<rule_id, kind, pattern, weight>``; empty for a null text."""
    if not rules:
        return F.array().cast(f"array<{HIT}>")
    pieces = [None if len(rules) <= few else required_piece(r.pattern) for r in rules]
    alone = [(k, r) for k, (r, p) in enumerate(zip(rules, pieces)) if p is None]
    parts = []
    if alone:
        parts.append(F.array_compact(F.array(*[
            F.when(text.rlike(r.pattern), F.struct(F.lit(k).alias("pos"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.kind).alias("kind"),
                                                   F.lit(r.pattern).alias("pattern"), F.lit(r.weight).alias("weight"))) for k, r in alone])))
    for fold in (False, True):
        some = [(k, r, p[0], p[2]) for k, (r, p) in enumerate(zip(rules, pieces)) if p is not None and p[1] == fold]
        if some:
            hits = F.filter(F.array_distinct(_candidates(F.lower(text) if fold else text, some)), lambda h: h["whole"] | F.rlike(text, h["pattern"]))
            parts.append(F.transform(hits, lambda h: F.struct(h["pos"].alias("pos"), h["rule_id"].alias("rule_id"), h["kind"].alias("kind"),
                                                             h["pattern"].alias("pattern"), h["weight"].alias("weight"))))
    every = parts[0] if len(parts) == 1 and alone else F.array_sort(F.concat(*parts))
    hits = F.transform(every, lambda h: F.struct(h["rule_id"].alias("rule_id"), h["kind"].alias("kind"), h["pattern"].alias("pattern"), h["weight"].alias("weight")))
    return F.when(text.isNotNull(), hits).otherwise(F.array().cast(f"array<{HIT}>"))
