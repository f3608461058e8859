"""A plain per-filing model of the extraction, to check the operators against. Tests only."""

import csv
import re
from collections import Counter

from ledgerline.functions.rules import (
    DEFAULT_CUT, HEADER_CLOSE, HEADER_KEYS, HEADER_OPEN, MISSING, RULES, TOTAL_RULES, VALUE_TOTAL,
)

RULE = {name: re.compile(pattern, re.I | re.A) for name, pattern in RULES.items()}


def accepted(words, keys):
    known = [w.upper() for w in words if w.upper() in keys or w.upper()[:6] in keys]
    return max(known, key=len) if known else None


def resolve(lines, keys):
    """(eligible, remainder) as {line_no: ...}."""
    good, rest = {}, {}
    for number, raw in enumerate(lines):
        raw = raw.rstrip()
        line = raw.replace("-", "")
        if RULE["SkipL"].search(raw):
            rest[number] = raw
        elif cusip := accepted(RULE["CUSIP"].findall(line), keys):
            tag = RULE["Shprn"].search(line[line.rfind(cusip) + len(cusip):] if cusip in line else line)
            good[number] = (cusip, tag.group(1) if tag else "", line)
        else:
            rest[number] = line
    return good, rest


def modal(texts, pattern, shift=0):
    hits = [m.start() + shift for t in texts if (m := re.search(pattern, t, re.A))]
    return Counter(hits).most_common(1)[0][0] if hits else None


def option(before, after):
    hit = RULE["Anyopt"].search(after) or RULE["Anyopt"].search(before + after)
    return (True, hit.group()) if hit else (False, "Unlikely")


def split(good):
    out = {}
    for number, (cusip, _, line) in good.items():
        before, found, after = line.partition(cusip)
        if found:
            out[number] = (cusip, before.rstrip(",\t"), after.lstrip(",\t"))
    return out


def layout_of(good, sides):
    half = len(good) // 2
    inside = [good[number][2] for number in sides]
    if sum("\t" in t for t in inside) > half:
        return "tab"
    if sum(t.count(",") > t.count(" ") for t in inside) > half:
        return "csv"
    if any("<HTML>" in t.upper() for t in inside):
        return "html"
    short = [t.strip() for c, _, t in good.values() if t.strip().startswith(c) and len(t.strip()) < len(c) + 5]
    return "garbage" if len(short) > half else "fixed"


def comma_rows(good):
    for number, (_, _, line) in good.items():
        fields = next(csv.reader([line]))
        if len(fields) > 5:
            rest = " ".join(fields[4:])
            yield number, bool(RULE["Anyopt"].search(fields[0] + rest)), fields[0], "N/A", *fields[1:4], "N/A", rest


def tab_rows(sides):
    cut = modal([b for _, b, _ in sides.values()], r"\t\w")
    cut = DEFAULT_CUT if cut is None else cut
    for number, (cusip, before, after) in sides.items():
        name, kind = before.split("\\t", 1) if "\\t" in before else (before[:cut], before[cut:])
        pair = re.search(r"(\d+)\t+(\d+)", after, re.A)
        value, shares = pair.groups() if pair else (after, MISSING)
        yield number, name, kind, cusip, value, shares, before, after


def fixed_rows(sides):
    bare = {n: (c, *(re.sub(r"[-\t.,$]", "", t) for t in (b, a))) for n, (c, b, a) in sides.items()}
    name_cut = modal([b for _, b, _ in bare.values()], r"\s{2}\w")
    name_cut = DEFAULT_CUT if name_cut is None else name_cut
    value_cut = modal([a for _, _, a in bare.values()], r"\d\s{2,}\d", 1)
    for number, (cusip, before, after) in bare.items():
        gap = re.search(r"\s{2,}(?=\w)", before, re.A)
        name, kind = (before[:gap.start()], before[gap.end():]) if gap else (before[:name_cut], before[name_cut:])
        pair = re.search(r"(\d+)\s{2,}(\d+)", after, re.A) or re.search(r"(\d+)\s(\d+)", after, re.A)
        if pair:
            value, shares = pair.groups()
        else:
            value, shares = (after[:value_cut], after[value_cut:]) if value_cut else (after, MISSING)
        yield number, name, kind, cusip, value, shares, before, after


def extract(lines, keys):
    """(layout, rows) of one filing; a row is line number, poss_hit and the seven texts."""
    good, _ = resolve(lines, keys)
    sides = split(good)
    layout = layout_of(good, sides)
    if layout == "csv":
        return layout, list(comma_rows(good))
    rows = []
    for number, *texts, before, after in {"tab": tab_rows, "fixed": fixed_rows}.get(layout, lambda _: [])(sides):
        hit, words = option(before, after)
        texts += [words, re.sub(r"[^\sA-Za-z]", "", after)]
        rows.append((number, hit, *(t.strip() for t in texts)))
    return layout, rows


def header(lines, own):
    """Header fields of one filing, read line by line."""
    fields = dict.fromkeys(HEADER_KEYS, "") | own
    inside = False
    for line in lines:
        if line.startswith((HEADER_OPEN, HEADER_CLOSE)):
            inside = line.startswith(HEADER_OPEN)
        key = line.strip().partition(":")[0]
        if inside and ":" in line and key in fields:
            fields[key] = line.rpartition(":")[2].strip()
        for total, rule in TOTAL_RULES.items():
            if total.lower() in line.lower() and not fields[total]:
                fields[total] = re.search(rule, line.lower() + "\n").group(1)
        if fields[VALUE_TOTAL]:
            break
    return fields


def splits(good):
    """Frequent positions of a fixed filing: {(side, pos): n}."""
    bare = [(re.sub(r"[-\t.,$]", "", b), re.sub(r"[-\t.,$]", "", a)) for _, b, a in split(good).values()]
    out = {}
    for side, pattern, shift, step in (("before", r"\s{2}\w", 0, 1), ("after", r"\d\s{2,}\d", 1, -1)):
        texts = [pair[side == "after"] for pair in bare]
        counts = Counter(m.start() + shift for t in texts if (m := re.search(pattern, t, re.A)))
        often = {p for p, n in counts.items() if n > len(bare) // 10}
        out |= {(side, p): counts[p] for p in often if p + step not in often}
    return out
