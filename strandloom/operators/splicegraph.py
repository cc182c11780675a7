"""Assembly by splice graphs: exons and introns as nodes, transcripts as paths of most evidence.

Structures of one strand give introns and inner exons, which are exact, and end exons, whose outer ends are free. End exons of one splice site
are one node, as wide as the widest; one inside an inner exon with the same site, give or take `fuzz`, is evidence for that exon. Where an end exon on the right reaches into one on the
left, the two make an inner exon. Structures of one exon are evidence for the exons that hold them.
A path is scored by how many structures its first exon has, and how many each further intron and exon bring that the exon before doesn't have; the best path through
each structure comes from the best scores up to it and from it on. Paths are taken by score while they hold a structure that no path taken before holds.

``graph_assemblies`` has the columns of ``assemble.assemblies`` and takes the same structures; a task holds the structures of one pile and strand, equal ones once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from strandloom.operators.assemble import FUZZ, Segments
from strandloom.operators.intervals import piles
from strandloom.plans.lineage import spread, stored

LEFT, INNER, RIGHT = 0, 1, 2
Exon = tuple[int, int, int]  # lend, rend, kind


def introns(s: Segments) -> list[tuple[int, int]]:
    return [(a[1] + 1, b[0] - 1) for a, b in zip(s, s[1:])]


def exons_of(structures: list[Segments], fuzz: int = FUZZ) -> list[Exon]:
    """The exon nodes of structures of two exons and more, in order."""
    inner = {(l, r) for s in structures for l, r in s[1:-1]}
    left: dict[int, int] = {}
    right: dict[int, int] = {}
    for s in structures:
        if len(s) > 1:
            left[s[0][1]] = min(left.get(s[0][1], s[0][0]), s[0][0])
            right[s[-1][0]] = max(right.get(s[-1][0], s[-1][1]), s[-1][1])
    inner |= {(a, d) for a, end in right.items() for d, begin in left.items() if a <= d and begin <= end}  # a right end that reaches into a left one
    ends = [(begin, d, LEFT) for d, begin in left.items() if not any(r == d and l <= begin + fuzz for l, r in inner)]
    ends += [(a, end, RIGHT) for a, end in right.items() if not any(l == a and end - fuzz <= r for l, r in inner)]
    return sorted([*ends, *((l, r, INNER) for l, r in inner)])


def holds(path: list[Exon], s: Segments, fuzz: int = FUZZ) -> bool:
    """Whether a structure is part of a path: its introns one after the other, its ends inside the path's exons by all but `fuzz`."""
    for k, e in enumerate(path):
        if k + len(s) > len(path):
            return False
        if len(s) > 1 and e[1] != s[0][1]:
            continue
        last = path[k + len(s) - 1]
        sites = all(path[k + i][1] == s[i][1] and path[k + i + 1][0] == s[i + 1][0] for i in range(len(s) - 1))
        if sites and e[0] - fuzz <= s[0][0] and s[-1][1] <= last[1] + fuzz and (len(s) > 1 or s[0][0] <= e[1] and s[0][1] >= e[0]):
            return True
    return False


def _evidence(exons: list[Exon], structures: list[Segments], fuzz: int) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Which structures, as bits, an exon and an intron have."""
    by_exon, by_intron = [0] * len(exons), {}
    begins, ends, whole = {}, {}, {}  # exons by the sites that they have
    for k, (l, r, kind) in enumerate(exons):
        if kind != LEFT:
            begins.setdefault(l, []).append((k, r))
        if kind != RIGHT:
            ends.setdefault(r, []).append((k, l))
        if kind == INNER:
            whole[l, r] = k
    for n, s in enumerate(structures):
        bit = 1 << n
        if len(s) == 1:
            a, b = s[0]
            for k, (l, r, _) in enumerate(exons):
                if l <= a + fuzz and r >= b - fuzz and a <= r and b >= l:
                    by_exon[k] |= bit
            continue
        for i in introns(s):
            by_intron[i] = by_intron.get(i, 0) | bit
        (a, b), (x, y) = s[0], s[-1]
        for k, l in ends.get(b, ()):
            if l <= a + fuzz and a <= b >= l:
                by_exon[k] |= bit
        for k, r in begins.get(x, ()):
            if r >= y - fuzz and x <= r and y >= x:
                by_exon[k] |= bit
        for e in s[1:-1]:
            if e in whole and e[0] <= e[1]:
                by_exon[whole[e]] |= bit
    return by_exon, by_intron


def _edges(exons: list[Exon], by_intron: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """(exon, next exon, the intron's structures)."""
    ends, begins = {}, {}
    for k, (l, r, kind) in enumerate(exons):
        if kind != RIGHT:
            ends.setdefault(r + 1, []).append(k)
        if kind != LEFT:
            begins.setdefault(l - 1, []).append(k)
    return sorted((a, b, bits) for (l, r), bits in by_intron.items() for a in ends.get(l, ()) for b in begins.get(r, ()))


def _best(paths: list[tuple[int, list[int]]]) -> tuple[int, list[int]]:
    """The path of the highest score, of equal ones that of the earlier exons."""
    return paths[0] if len(paths) == 1 else max(paths, key=lambda p: (p[0], [-x for x in p[1]]))


def best_paths(exons: list[Exon], structures: list[Segments], fuzz: int = FUZZ, evidence=None) -> tuple[list[tuple[int, list[int]]], list[tuple[int, list[int]]]]:
    """The best path that ends at each exon, and the best one that begins there, as (score, exons); a path's score is that of ``path_score``."""
    by_exon, by_intron = evidence or _evidence(exons, structures, fuzz)
    edges = _edges(exons, by_intron)
    into: list[list[tuple[int, int]]] = [[] for _ in exons]
    onto: list[list[tuple[int, int]]] = [[] for _ in exons]
    for a, b, bits in edges:
        gain = ((bits | by_exon[b]) & ~by_exon[a]).bit_count()
        into[b].append((a, gain))
        onto[a].append((b, gain))
    order = sorted(range(len(exons)), key=lambda k: (exons[k][0], exons[k][1]))
    up: list[tuple[int, list[int]]] = [(0, [])] * len(exons)
    down: list[tuple[int, list[int]]] = [(0, [])] * len(exons)
    for k in order:
        start = by_exon[k].bit_count()
        up[k] = _best([(up[a][0] + g, [*up[a][1], k]) for a, g in into[k]] or [(start, [k])])
    for k in reversed(order):  # the score of what comes behind k
        down[k] = _best([(g + down[b][0], [k, *down[b][1]]) for b, g in onto[k]] or [(0, [k])])
    return up, down


def path_score(path: list[int], exons: list[Exon], structures: list[Segments], fuzz: int = FUZZ, evidence=None) -> int:
    by_exon, by_intron = evidence or _evidence(exons, structures, fuzz)
    out = by_exon[path[0]].bit_count()
    for a, b in zip(path, path[1:]):
        out += ((by_intron[exons[a][1] + 1, exons[b][0] - 1] | by_exon[b]) & ~by_exon[a]).bit_count()
    return out


def through(s: Segments, exons: list[Exon], up: list, down: list, scored, fuzz: int = FUZZ) -> tuple[int, list[int]] | None:
    """The best path that holds a structure of two exons and more."""
    best = None
    firsts = [k for k, (l, r, kind) in enumerate(exons) if r == s[0][1] and kind != RIGHT and l <= s[0][0] + fuzz]
    lasts = [k for k, (l, r, kind) in enumerate(exons) if l == s[-1][0] and kind != LEFT and r >= s[-1][1] - fuzz]
    middle = [exons.index((l, r, INNER)) for l, r in s[1:-1]]
    for a in firsts:
        for b in lasts:
            path = [*up[a][1], *middle, *down[b][1]]
            score = scored(path)
            if best is None or (score, [-x for x in path]) > (best[0], [-x for x in best[1]]):
                best = (score, path)
    return best


def assemble_graph(structures: list[Segments], fuzz: int = FUZZ) -> list[tuple[Segments, list[int]]]:
    """(segments, members) of one strand's assemblies; structures of one exon that no path holds are united where they overlap."""
    if len(structures) == 1 and all(a[1] < b[0] for a, b in zip(structures[0], structures[0][1:])):
        return [(list(structures[0]), [0])]
    many = [s for s in structures if len(s) > 1]
    exons = exons_of(many, fuzz)
    # which structures an exon and an intron have is found once for all paths
    evidence = _evidence(exons, structures, fuzz)
    up, down = best_paths(exons, structures, fuzz, evidence)
    paths: dict[tuple[int, ...], int] = {}
    for s in many:
        got = through(s, exons, up, down, lambda p: path_score(p, exons, structures, fuzz, evidence), fuzz)
        if got:
            paths[tuple(got[1])] = got[0]
    out, seen = [], set()
    for path in sorted(paths, key=lambda p: (-paths[p], p)):
        nodes = [exons[k] for k in path]
        sites = {e[1] for e in nodes}
        members = [n for n, s in enumerate(structures) if (len(s) == 1 or s[0][1] in sites) and holds(nodes, s, fuzz)]
        if not seen.issuperset(members):
            seen.update(members)
            out.append(([(l, r) for l, r, _ in nodes], members))
    rest = sorted((structures[n][0][0], structures[n][-1][1], n) for n in range(len(structures)) if n not in seen)
    group: list[tuple[int, int, int]] = []
    for row in [*rest, None]:
        if group and (row is None or row[0] > max(g[1] for g in group)):
            out.append(([(group[0][0], max(g[1] for g in group))], sorted(g[2] for g in group)))
            group = []
        if row:
            group.append(row)
    return out


def graph_assemblies(structures: DataFrame, fuzz: int = FUZZ) -> DataFrame:
    """(contig, pile, strand, number, members, size, segments) from (contig, acc, strand, segments array<struct<lend, rend>>); piles are of one strand, a structure
    of strand '?' counts as '+'; number is by size, then by segments."""
    c = F.col
    known = structures.withColumn("strand", F.when(c("strand") == "-", "-").otherwise("+"))
    # piles read their rows three times
    spans = stored(known.select("contig", "acc", "strand", "segments")).select("*", F.element_at("segments", 1)["lend"].alias("lend"), F.element_at("segments", -1)["rend"].alias("rend"), c("acc").alias("id"))
    piled = piles(spans, ("contig", "strand"))
    # equal structures are one row; their ends follow one another in one flat list, which Python reads and writes faster than nested ones
    flat = F.flatten(F.transform("segments", lambda e: F.array(e["lend"].cast("int"), e["rend"].cast("int"))))
    names = ["contig", "strand", "pile"]
    rows = stored(piled.groupBy(*names, flat.alias("segments")).agg(F.sort_array(F.collect_list("acc")).alias("accs")))
    kind, acc = structures.schema["contig"].dataType.simpleString(), structures.schema["acc"].dataType.simpleString()
    schema = f"contig {kind}, strand string, pile bigint, number int, accs array<{acc}>, size int, segments string"
    arrow = to_arrow_schema(structures.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        key, held, accs, out = None, [], [], []

        def close() -> None:
            found = [(sorted(a for n in got for a in accs[n]), s) for s, got in assemble_graph(held, fuzz)] if held else []
            found.sort(key=lambda f: (-len(f[0]), f[1]))
            out.extend((*key, number, own, len(own), ",".join(f"{l}-{r}" for l, r in s)) for number, (own, s) in enumerate(found, 1))

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            cells = [batch.column(k).to_pylist() for k in range(3)]
            ends, at = (batch.column(3).flatten().to_pylist(), [x - batch.column(3).offsets[0].as_py() for x in batch.column(3).offsets.to_pylist()])
            for i, (own, got) in enumerate(zip(zip(*cells), batch.column(4).to_pylist())):
                if own != key:
                    close()
                    key, held, accs = own, [], []
                parts = iter(ends[at[i] : at[i + 1]])
                held.append(list(zip(parts, parts)))
                accs.append(got)
            if len(out) >= 500:
                yield made()
        close()
        if out:
            yield made()

    solved = spread(rows, *names).sortWithinPartitions(*names, "segments").select(*names, "segments", "accs").mapInArrow(run, schema)
    return solved.select("contig", "pile", "strand", "number", F.array_join(c("accs").cast("array<string>"), ",").alias("members"), "size", "segments")
