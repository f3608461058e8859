"""Checks of rules that users bring, before they become patterns in a plan.

Rules are written in Python's dialect and run in Java's. What the two read differently is refused, and
so is a repeat without bound inside another one, which can take a line exponential time. Runs on the
driver over a few short texts.
"""

from __future__ import annotations

import re

# What may follow a backslash and means the same in both dialects.
_SAME_ESCAPES = set("dDwWsSbBAnrtfaxu123456789")
# Flags that mean the same in both dialects.
_SAME_FLAGS = set("ims")
_UNBOUNDED = re.compile(r"[*+]|\{\d+,\}")
_COUNTED = re.compile(r"\{\d+(?:,\d*)?\}")


class RuleError(ValueError):
    """A rule that is refused: which, why, and where."""

    def __init__(self, name: str, reason: str, offset: int | None, group: str | None = None):
        where = "" if offset is None else f" at offset {offset}"
        super().__init__(f"rule {name}: {reason}{where}{f' in group {group}' if group else ''}")
        self.rule, self.reason, self.offset, self.group = name, reason, offset, group


def check_rule(name: str, pattern: str) -> None:
    """Raise RuleError if a rule is no pattern, means something else in Java, or nests unbounded repeats."""
    try:
        re.compile(pattern)
    except re.error as error:
        raise RuleError(name, error.msg, error.pos) from None
    _Walk(name, pattern).run()


class _Walk:
    """One pass over a pattern that Python accepts."""

    def __init__(self, name: str, pattern: str):
        self.name, self.pattern, self.at = name, pattern, 0
        # Open groups: offset, name, whether an unbounded repeat is inside, whether its matches are kept whole.
        self.groups: list[list] = [[0, None, False, False]]
        self.numbered = 0

    def refuse(self, reason: str, offset: int | None = None) -> None:
        raise RuleError(self.name, reason, self.at if offset is None else offset, self.groups[-1][1])

    def run(self) -> None:
        while self.at < len(self.pattern):
            char = self.pattern[self.at]
            if char == "\\":
                self.escape()
                self.repeated(False)
            elif char == "[":
                self.letters()
                self.repeated(False)
            elif char == "(":
                self.opened()
            elif char == ")":
                start, label, inside, whole = self.groups.pop()
                self.at += 1
                self.repeated(inside and not whole, start, label)
            elif char == "{":
                self.refuse("a brace that begins no count needs a backslash")
            else:
                self.at += 1
                if char not in "|^$":
                    self.repeated(False)

    def escape(self) -> None:
        code = self.pattern[self.at + 1]
        if code == "Z":
            self.refuse("\\Z ends before a line end in Java; use $")
        if code.isalnum() and code not in _SAME_ESCAPES:
            self.refuse(f"\\{code} is read otherwise by Java")
        self.at += 2

    def letters(self) -> None:
        """A character class; its first letter may be a closing bracket."""
        start = self.at
        self.at += 2 if self.pattern[self.at + 1 : self.at + 2] == "^" else 1
        if self.pattern[self.at] == "]":
            self.refuse("a closing bracket in a class needs a backslash")
        while self.pattern[self.at] != "]":
            if self.pattern[self.at] == "\\":
                self.escape()
                continue
            if self.pattern[self.at] == "[":
                self.refuse("a bracket in a class needs a backslash")
            if self.pattern.startswith("&&", self.at):
                self.refuse("&& in a class is an intersection in Java")
            self.at += 1
        if self.at == start + 1:
            self.refuse("empty class", start)
        self.at += 1

    def opened(self) -> None:
        start, rest = self.at, self.pattern[self.at + 1 :]
        label, whole, head = None, False, ""
        if not rest.startswith("?"):
            self.numbered += 1
            label = str(self.numbered)
        elif found := re.match(r"\?P<([^>]*)>", rest):
            self.numbered += 1
            label, head = found[1], found[0]
            if not re.fullmatch(r"[A-Za-z][A-Za-z0-9]*", label):
                self.refuse(f"group name {label}: Java takes ASCII letters and digits")
        elif found := re.match(r"\?(?:[:=!]|<[=!])", rest):
            head = found[0]
        elif rest.startswith("?>"):
            head, whole = "?>", True
        elif found := re.match(r"\?([a-zA-Z]*)(-[a-zA-Z]+)?([:)])", rest):
            if not set(found[1] + (found[2] or "-")[1:]) <= _SAME_FLAGS:
                self.refuse("a flag that Java reads otherwise")
            head = found[0]
            if found[3] == ")":
                self.at += 1 + len(head)
                return
        else:
            self.refuse("a group that Java does not have")
        self.groups.append([start, label, False, whole])
        self.at += 1 + len(head)

    def repeated(self, inside: bool, start: int | None = None, label: str | None = None) -> None:
        """What follows an item; ``inside`` says that the item holds an unbounded repeat that can give back."""
        found = _UNBOUNDED.match(self.pattern, self.at)
        if found:
            at = self.at
            self.at = found.end()
            kept = self.pattern.startswith("+", self.at)
            if kept or self.pattern.startswith("?", self.at):
                self.at += 1
            if inside and not kept:
                where = f"group {label}" if label else "a group"
                raise RuleError(self.name, f"{where}, opened at offset {start}, repeats without bound what does so itself", at, label)
            inside = inside or not kept
        elif self.pattern.startswith("{,", self.at):
            self.refuse("a count without its least number is no count in Java")
        elif counted := _COUNTED.match(self.pattern, self.at):
            self.at = counted.end()
            if self.pattern[self.at : self.at + 1] in ("?", "+"):
                self.at += 1
        elif self.pattern.startswith("?", self.at):
            self.at += 1
            if self.pattern[self.at : self.at + 1] in ("?", "+"):
                self.at += 1
        if inside and self.groups:
            self.groups[-1][2] = True
