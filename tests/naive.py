"""One-row-at-a-time versions of the ordered rules, to test against."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import regex

from corpusgrove.functions import grammar as G


@dataclass(eq=False)
class N:
    name: str
    lvl: int
    count: int = 1
    desc: str = ""
    up: "N | None" = None
    kids: list = field(default_factory=list)

    def put(self, name, lvl, count, desc):
        """Add a child; an exact namesake only gains the count."""
        for kid in self.kids:
            if kid.name == name:
                kid.count += count
                return None
        kid = N(name, lvl, count, desc, self)
        self.kids.append(kid)
        return kid


def new_tree():
    return N("root", 0)


def walk(node):
    for kid in node.kids:
        yield kid
        yield from walk(kid)


def find(root, name, lvl):
    return [n for n in walk(root) if n.name.lower() == name.lower() and n.lvl == lvl]


def dump(root):
    """Rows ``(names from the root, lvl, count, desc)`` in depth-first order."""

    def trail(n):
        return () if n.up is None else (*trail(n.up), n.name)

    return [(trail(n), n.lvl, n.count, n.desc) for n in walk(root)]


def tree_rows(spark, root):
    """The tree as a table, and back through ``dump_table``."""
    rows, counter = [], [0]

    def visit(n, path):
        for kid in n.kids:
            counter[0] += 1
            here = [*path, counter[0]]
            rows.append((here, kid.lvl, kid.name, kid.count, kid.desc))
            visit(kid, here)

    visit(root, [])
    return spark.createDataFrame(rows, "path array<bigint>, lvl int, name string, count bigint, desc string")


def dump_table(df):
    rows = sorted(df.collect(), key=lambda r: list(r.path))
    names = {tuple(r.path): r.name for r in rows}
    return [
        (tuple(names[tuple(r.path[: i + 1])] for i in range(len(r.path))), r.lvl, r["count"], r.desc) for r in rows
    ]


def nest(lines):
    """Topic lines ``(lvl, name, count, desc)`` into a tree."""
    root = new_tree()
    latest = {0: root}
    for lvl, name, count, desc in lines:
        if lvl - 1 in latest:
            made = latest[lvl - 1].put(name, lvl, count, desc)
            if made:
                latest[lvl] = made
    return root


def fold_level1(responses, patience, root=None):
    """Tree and number of documents kept."""
    root = root or new_tree()
    repeats = 0
    for i, (text, status) in enumerate(responses):
        if status == "error":
            return root, i + 1
        for line in text.split("\n"):
            m = regex.match(G.LEVEL1_LINE, line.strip())
            if not m or int(m[1]) != 1:
                continue
            name, desc = m[2].strip(), m[3].strip()
            known = find(root, name, 1)
            if known:
                known[0].count += 1
                repeats += 1
                if repeats > patience:
                    return root, i
            else:
                root.put(name, 1, 1, desc)
                repeats = 0
    return root, len(responses)


def merge(root, originals, name, desc):
    matched = [n for old, lvl in originals for n in find(root, old, lvl)]
    parent = matched[0].up if matched else root
    total = sum(n.count for n in matched)
    reused = next((k for k in parent.kids if k.name == name), None)
    if reused:
        reused.count, reused.desc = total, desc
    else:
        parent.put(name, parent.lvl + 1, total, desc)
    for node in matched:
        if node is reused:
            continue
        hit = next((n for n in walk(root) if n.name == node.name and n.lvl == node.lvl), None)
        if hit:
            hit.up.kids.remove(hit)


def fold_subtopics(root, responses):
    for text in responses:
        under = None
        for line in text.strip().split("\n"):
            m = regex.match(G.SUBTOPIC_LINE, line.strip())
            if not m:
                continue
            if ":" in line and under is not None:
                under.put(m[2].strip(), 2, 1, m[5].strip(" :"))
            else:
                hits = find(root, m[2].strip(), int(m[1]))
                under = hits[0] if hits else under
    return root


TOKEN = regex.compile(G.TOKEN.replace(r"\s", r"\t\n\x0b\x0c\r "))


def count(text):
    return len(TOKEN.findall(text))


def truncate(text, n):
    n = max(n, 0)
    found = list(TOKEN.finditer(text))
    if len(found) <= n:
        return text
    return text[: found[n - 1].end()] if n else ""


def pack(sizes, budget):
    fill, batch, out = 0, 0, []
    for size in sizes:
        if fill + size >= budget:
            batch, fill = batch + 1, 0
        fill += size
        out.append(batch)
    return out


def budget_prefix(scored, budget):
    """``scored``: (similarity, tokens, label) in tree order."""
    used, out = 0, []
    for sim, size, label in sorted(scored, key=lambda t: -t[0]):
        if used >= budget or used + size > budget:
            break
        used += size
        out.append(label)
    return out


def floor_prefix(scored, limit, floor):
    kept = sorted(scored, key=lambda t: -t[0])
    while sum(t[1] for t in kept) > limit and len(kept) > floor:
        kept.pop()
    return [t[2] for t in kept]


def rewrite(text, mapping):
    out = []
    for line in text.split("\n"):
        for old, new in mapping:
            if old != new and old in line:
                line = line.replace(old, new)
        out.append(line)
    return "\n".join(out)


def words(text):
    return re.findall(r"[^\W_]+", text.lower())
