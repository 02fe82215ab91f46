"""Column functions on CIGAR strings; positions count from 0, lengths are longs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = r"\d+[MIDNSHP=X]"


def once(value: Column, f) -> Column:
    """f(value), where value is worked out once for each row, however often f names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def parse_cigar(cigar: Column) -> Column:
    """Array of (op, len); null, empty and * give an empty array."""
    found = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(_OPS), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.left(x, F.length(x) - 1).cast("long").alias("len")))


def bases(parsed: Column, ops: str) -> Column:
    """Bases of the given operations together, of a parsed CIGAR."""
    return F.aggregate(parsed, F.lit(0).cast("long"), lambda a, x: F.when(x["op"].isin(*ops), a + x["len"]).otherwise(a))


def cigar_total(cigar: Column, ops: str) -> Column:
    """Bases of the given operations together."""
    return bases(parse_cigar(cigar), ops)


def matched(cigar: Column, fold: bool = True) -> Column:
    """Matched bases; `=` and `X` are folded in unless told otherwise."""
    return cigar_total(cigar, "M=X" if fold else "M")


def reference_span(cigar: Column, start: Column) -> Column:
    """(query_start, query_end, ref_end) of an alignment that starts at `start`."""
    parsed = parse_cigar(cigar)
    lead = F.coalesce(F.get(F.filter(F.slice(parsed, 1, 1), lambda x: x["op"].isin("S", "H")), F.lit(0))["len"], F.lit(0).cast("long"))
    return F.struct(lead.alias("query_start"), (lead + cigar_total(cigar, "MI=X")).alias("query_end"), (start + cigar_total(cigar, "MDN=X")).alias("ref_end"))


def events(cigar: Column, start: Column) -> Column:
    """Insertions, deletions and clips as (pos, op, len), each at the reference position where it begins.

    Skipped bases (N) advance the position as deletions do.
    """
    return parsed_events(parse_cigar(cigar), start)


def parsed_events(parsed: Column, start: Column) -> Column:
    """`events` of a parsed CIGAR."""
    begin = F.struct(start.cast("long").alias("pos"), F.array().cast("array<struct<pos:bigint,op:string,len:bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        moved = F.when(x["op"].isin("M", "D", "N", "=", "X"), x["len"]).otherwise(F.lit(0).cast("long"))
        found = F.struct(acc["pos"].alias("pos"), x["op"].alias("op"), x["len"].alias("len"))
        out = F.when(x["op"].isin("I", "D", "S"), F.array_append(acc["out"], found)).otherwise(acc["out"])
        return F.struct((acc["pos"] + moved).alias("pos"), out.alias("out"))

    return F.aggregate(parsed, begin, step, lambda acc: acc["out"])


def largest_indel(cigar: Column, start: Column, around: Column, window: int) -> Column:
    """The longest insertion or deletion within `window` of a position, the first of equal ones; null if none."""
    return largest_of(events(cigar, start), around, window)


def largest_of(found: Column, around: Column, window: int) -> Column:
    """`largest_indel` of events."""
    near = F.filter(found, lambda e: e["op"].isin("I", "D") & (F.abs(e["pos"] - around) <= window))
    best = F.array_max(F.transform(near, lambda e: F.struct(e["len"].alias("len"), (-e["pos"]).alias("neg"), e["op"].alias("op"))))
    return F.when(best.isNotNull(), F.struct((-best["neg"]).alias("pos"), best["op"].alias("op"), best["len"].alias("len")))


def aligned_positions(cigar: Column, start: Column, moving: str = "MDN=X") -> Column:
    """Positions that matched bases cover, from start on; the operations in `moving` move the position."""
    begin = F.struct(start.cast("long").alias("pos"), F.array().cast("array<array<bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        ends = acc["pos"] + F.when(x["op"].isin(*moving), x["len"]).otherwise(F.lit(0).cast("long"))
        out = F.when(x["op"].isin("M", "=", "X"), F.array_append(acc["out"], F.sequence(acc["pos"], ends - 1))).otherwise(acc["out"])
        return F.struct(ends.alias("pos"), out.alias("out"))

    return F.flatten(F.aggregate(parse_cigar(cigar), begin, step, lambda acc: acc["out"]))


def aligned_overlap(one: Column, start_one: Column, two: Column, start_two: Column) -> Column:
    """Number of reference positions that both alignments cover with matched bases."""
    return F.size(F.array_intersect(aligned_positions(one, start_one), aligned_positions(two, start_two))).cast("long")


def clipped_overlap_share(one: Column, two: Column) -> Column:
    """Share of the first alignment's matched places, counted from the read's start with its clips, that the second matches too."""
    first, second = (aligned_positions(c, F.lit(0), "MDN=XSH") for c in (one, two))
    return F.size(F.array_intersect(first, second)) / F.nullif(F.size(first), F.lit(0))


def softclip_distance(cigar: Column, start: Column, targets: Column, none: int = 999) -> Column:
    """Least distance from a soft-clip junction to one of the target positions; `none` if there is no such pair."""
    return clip_distance_of(events(cigar, start), targets, none)


def clip_distance_of(found: Column, targets: Column, none: int = 999) -> Column:
    """`softclip_distance` of events."""
    clips = F.filter(found, lambda e: e["op"] == "S")
    gaps = F.flatten(F.transform(clips, lambda e: F.transform(targets, lambda t: F.abs(e["pos"] - t))))
    return F.coalesce(F.array_min(gaps), F.lit(none).cast("long"))


def size_class(size: Column) -> Column:
    """0 without an indel, 1 up to 3 bases, 2 up to 10, 3 above."""
    return F.when(size <= 0, 0).when(size <= 3, 1).when(size <= 10, 2).otherwise(3)


def complexity(ops: Column, size: Column) -> Column:
    return F.least(ops + size / 10, F.lit(10.0))


def ins_del_ratio(inserted: Column, deleted: Column) -> Column:
    """Inserted over deleted bases, 10 without deletions but with insertions, 0 without either."""
    return F.when(deleted > 0, inserted / deleted).when(inserted > 0, F.lit(10.0)).otherwise(F.lit(0.0))


def clip_deletions(parsed: Column, least: int = 3, most: int = 50) -> Column:
    """Deleted bases that the soft clips of a parsed CIGAR hint at.

    A clip of `least` bases or more counts once for itself, once more at an end of a read with over 5 matched bases, and
    once more inside it with over 2 on both sides. A deletion of up to `most` bases counts once for each such clip beside
    it; one between two such clips once more; two of them around such a clip once more each.
    """
    total = bases(parsed, "M")
    zero = F.lit(0).cast("long")

    def clipped(x: Column) -> Column:
        return F.coalesce((x["op"] == "S") & (x["len"] >= least), F.lit(False))

    def short(x: Column) -> Column:
        return F.coalesce((x["op"] == "D") & (x["len"] <= most), F.lit(False))

    def hint(x: Column, i: Column) -> Column:
        before, after = F.get(parsed, i - 1), F.get(parsed, i + 1)
        inside = (bases(F.slice(parsed, F.lit(1), i), "M") > 2) & (bases(F.slice(parsed, i + 2, F.size(parsed)), "M") > 2)
        end = (i == 0).cast("int") + (i == F.size(parsed) - 1).cast("int")
        beside = F.when(short(before), before["len"]).otherwise(zero) + F.when(short(after), after["len"]).otherwise(zero)
        again = F.when(short(before) & short(after), beside).otherwise(zero)
        own = x["len"] * (1 + F.when(total > 5, end).otherwise(0) + inside.cast("int"))
        between = F.when(short(x) & clipped(before) & clipped(after), x["len"]).otherwise(zero)
        return F.when(clipped(x), own + beside + again).otherwise(between)

    return F.aggregate(F.transform(parsed, hint), zero, lambda a, x: a + x)


def supplementary_clips(sa: Column, least: int = 3) -> Column:
    """Bases of the soft clips of `least` or more in the CIGARs of an SA tag (chrom,pos,strand,CIGAR,...;...)."""
    cigars = F.transform(F.split(F.coalesce(sa, F.lit("")), ";"), lambda e: F.coalesce(F.get(F.split(e, ","), F.lit(3)), F.lit("")))
    sizes = F.flatten(F.transform(cigars, lambda c: F.regexp_extract_all(c, F.lit(r"(\d+)S"), F.lit(1))))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + F.when(n.cast("long") >= least, n.cast("long")).otherwise(0))


def tag_letters(md: Column) -> Column:
    """Letters of an MD tag, deleted bases among them; 0 without a tag."""
    return F.length(F.regexp_replace(F.coalesce(md, F.lit("")), "[^A-Za-z]", "")).cast("long")


def edit_mismatches(nm: Column, parsed: Column) -> Column:
    """Mismatches by the NM tag: less the inserted and deleted bases, 0 at least and without a tag."""
    return F.greatest(F.coalesce(nm, F.lit(0)) - bases(parsed, "ID"), F.lit(0)).cast("long")


def indel_evidence(cigar: Column, nm: Column, md: Column, sa: Column) -> Column:
    """(inserted, deleted, clipped, mismatches, md_mismatches) of a read.

    deleted holds the CIGAR's deletions, what its clips hint at, and the clips of its supplementary alignments.
    Mismatches are told by the NM tag and, in the other form, by the letters of the MD tag.
    """
    return once(parse_cigar(cigar), lambda parsed: evidence_of(parsed, nm, md, sa))


def evidence_of(parsed: Column, nm: Column, md: Column, sa: Column) -> Column:
    """`indel_evidence` of a parsed CIGAR, a column or a variable: it is named many times."""
    zero = F.lit(0).cast("long")
    has = F.exists(parsed, lambda x: x["op"].isin("S", "D"))
    dele = bases(parsed, "D") + F.when(has, clip_deletions(parsed)).otherwise(zero) + F.when(F.size(parsed) > 0, supplementary_clips(sa)).otherwise(zero)
    return F.struct(
        bases(parsed, "I").alias("inserted"), dele.alias("deleted"), bases(parsed, "S").alias("clipped"), edit_mismatches(nm, parsed).alias("mismatches"), tag_letters(md).alias("md_mismatches")
    )
