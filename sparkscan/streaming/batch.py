"""Streams held as tables: rows ``(stream_id, seq, payload[, control, offset])``.

A stream is one haystack that arrives in pieces. Its global byte offsets come
from a bucketed running sum, then its bytes are dealt out again in blocks of
fixed size with the context a match may need. A hot stream is thereby scanned
by as many tasks as it has blocks, and no task holds more than one block.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions.cuts import Cut, block_state, cut_events, cut_rows
from ..functions.regex import RIGHT_CONTEXT, RuleError
from ..operators.numbering import running_before
from ..operators.rules import Rule, horizon_bytes
from ..operators.scan import Combination, _Plan, segment_events, split_rules
from ..session import stored

STREAM_BLOCK = 65_536
CHUNK = 4096
# What a control row may say.
RESET, CLOSE, RESTORE = "reset", "close", "restore"

_INCOMPLETE = (
    "(?:[\\x{c2}-\\x{df}]|[\\x{e0}-\\x{ef}][\\x{80}-\\x{bf}]?|[\\x{f0}-\\x{f4}][\\x{80}-\\x{bf}]{0,2})\\z"
)


def chunks_of(df: DataFrame, *, payload: str = "text", key: str = "doc_id", size: int = CHUNK) -> DataFrame:
    """Cut haystacks into blocks of ``size`` bytes: ``(stream_id, seq, payload BINARY)``."""
    view = S.byte_view(F.col(payload))
    pieces = F.regexp_extract_all(view, F.lit(f"[\\s\\S]{{1,{size}}}"), F.lit(0))
    cut = df.select(F.col(key).alias("stream_id"), F.posexplode(pieces).alias("seq", "piece"))
    return cut.select("stream_id", F.col("seq").cast("bigint").alias("seq"), F.encode("piece", "ISO-8859-1").alias("payload"))


def with_offsets(chunks: DataFrame) -> DataFrame:
    """``(stream_id, epoch, seq, off, data, silent)`` with global byte offsets.

    A reset row ends the stream's epoch and starts the next at offset 0; a
    restore row does so too, but continues from a saved state: its payload is
    the saved tail, which is context only, and ``offset`` the position after it.
    """
    names = set(chunks.columns)
    control = F.col("control") if "control" in names else F.lit(None).cast("string")
    at = F.col("offset") if "offset" in names else F.lit(None).cast("bigint")
    data = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = chunks.select(
        "stream_id", F.col("seq").cast("bigint").alias("seq"), data.alias("data"),
        control.alias("control"), at.cast("bigint").alias("at"), *(["carried"] if "carried" in names else []),
    ).withColumn("n", F.octet_length("data").cast("bigint"))
    if "control" not in names:
        placed = running_before(rows, ["stream_id"], "seq", {"off": F.col("n")})
        return placed.where(F.col("n") > 0).select(
            "stream_id", F.lit(0).cast("bigint").alias("epoch"), "seq", "off", "data", F.lit(False).alias("silent"))
    opens = F.coalesce(F.col("control").isin(RESET, RESTORE), F.lit(False))
    restores = F.coalesce(F.col("control") == RESTORE, F.lit(False))
    advance = F.when(restores, F.coalesce("at", "n")).otherwise(F.when(opens, F.lit(0)).otherwise(F.col("n")))
    placed = running_before(
        rows, ["stream_id"], "seq", {"total": advance, "epochs": opens.cast("int")}, at_last={"since": ("total", opens)})
    start = F.when(opens, F.col("total")).otherwise(F.coalesce("since", F.lit(0)))
    off = F.col("total") - start + F.when(restores, F.coalesce("at", "n") - F.col("n")).otherwise(F.lit(0))
    return placed.where((F.col("n") > 0) & (restores | ~opens)).select(
        "stream_id", (F.col("epochs") + opens.cast("bigint")).alias("epoch"), "seq", off.alias("off"), "data",
        restores.alias("silent"), *(["carried"] if "carried" in names else []))


def blocks_of(placed: DataFrame, left: int, right: int, size: int = STREAM_BLOCK) -> DataFrame:
    """Deal stream bytes out in blocks: ``(stream_id, epoch, base, lo, hi, text)`` in the byte view.

    Each chunk goes to the blocks that need bytes of it, already cut to the
    range they need, so a block's group is bounded in bytes.
    """
    n = F.octet_length("data")
    first = F.greatest(F.floor((F.col("off") - right) / size), F.lit(0))
    last = F.floor((F.col("off") + n + left - 1) / size)
    dealt = placed.select(
        "stream_id", "epoch", "off", "data", "silent", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("off"), F.col("block") * size - left)
    end = F.least(F.col("off") + F.octet_length("data"), (F.col("block") + 1) * size + right)
    piece = F.substring(F.col("data"), (start - F.col("off") + 1).cast("int"), (end - start).cast("int"))
    cut = dealt.select(
        "stream_id", "epoch", "block", start.alias("s"), end.alias("e"), "silent",
        F.decode(piece, "ISO-8859-1").alias("piece"))
    # the search that follows is CPU bound: keep the configured number of partitions, which
    # AQE would otherwise merge by size; the grouping below needs no exchange of its own
    key = ["stream_id", "epoch", "block"]
    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = cut.repartition(parts, *key).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("s", "piece"))).alias("pieces"),
        F.max(F.when(F.col("silent"), F.col("e"))).alias("quiet"),
        F.max("e").alias("end"),
    )
    begin = F.col("block") * size
    return grouped.where(F.col("end") > begin).select(
        "stream_id", "epoch",
        F.col("pieces")[0]["s"].alias("base"),
        F.greatest(begin, F.coalesce("quiet", F.lit(0).cast("bigint"))).alias("lo"),
        (begin + size).alias("hi"),
        "block", "quiet",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
    )


def _as_characters(s: Column) -> Column:
    """A byte-view block as UTF-8 text; characters cut at its edges are dropped."""
    def trimmed(t: Column) -> Column:
        body = F.regexp_replace(F.regexp_replace(t, _INCOMPLETE, ""), "\\A[\\x{80}-\\x{bf}]{1,3}", "")
        dropped = F.length(F.regexp_extract(t, "\\A[\\x{80}-\\x{bf}]{1,3}", 0))
        return S.segment(s["base"] + dropped, s["lo"], s["hi"], S.char_view(S.as_text(body, False)))

    return S.let(s["text"], trimmed)


def _whole_runs(blocks: DataFrame, plan: _Plan, size: int) -> DataFrame:
    """Stretches no match can leave, put together across blocks: ``(stream_id, epoch, base, lo, hi, text)``.

    A match holds only characters of the rule's cover class, so the text may be
    parted after any other character. Each block with such a character closes
    the stretch before it and opens the next; how many did so before it numbers
    the stretch. A group is as long as the longest possible match around it.
    """
    cover = plan.p.cover
    begin = F.greatest("base", F.col("hi") - size)
    body_at = (begin - F.col("base")).cast("int")
    body = F.substring(F.col("text"), body_at + 1, (F.col("hi") - begin).cast("int"))
    rest = F.length(F.regexp_extract("body", f"{plan.p.flags}{cover}*+\\z", 0))
    rows = blocks.select(
        "stream_id", "epoch", "block", "quiet", "text", begin.alias("at"), body_at.alias("skip"), body.alias("body"))
    rows = rows.withColumn("cut", F.length("body") - rest).withColumn("breaks", (F.col("cut") > 0).cast("bigint"))
    numbered = running_before(rows, ["stream_id", "epoch"], "block", {"run": F.col("breaks")})
    cut, skip = F.col("cut"), F.col("skip")

    def piece(run, at, left, text, right):
        return F.struct(run.cast("bigint").alias("run"), at.cast("bigint").alias("at"), left.alias("left"), text.alias("text"), right.alias("right"))

    none = F.lit("")
    closing = piece(F.col("run"), F.col("at"), none, F.left("body", cut), F.substring(F.col("text"), skip + cut + 1, F.lit(RIGHT_CONTEXT)))
    opening = piece(F.col("run") + 1, F.col("at") + cut, F.substring(F.col("body"), cut, F.lit(1)), F.substring(F.col("body"), cut + 1, F.length("body")), none)
    going_on = piece(F.col("run"), F.col("at"), none, F.col("body"), none)
    pieces = F.when(cut > 0, F.array(closing, opening)).otherwise(F.array(going_on))
    grouped = numbered.select("stream_id", "epoch", "block", "quiet", F.inline(pieces)).groupBy("stream_id", "epoch", "run").agg(
        F.array_sort(F.collect_list(F.struct("at", "block", "left", "text", "right"))).alias("ps"), F.max("quiet").alias("quiet"))
    first, last = F.col("ps")[0], F.element_at("ps", -1)
    text = F.concat(first["left"], F.array_join(F.transform("ps", lambda p: p["text"]), ""), last["right"])
    # text after the stretch is context: no match reaches into it
    return grouped.select(
        "stream_id", "epoch", (first["at"] - F.length(first["left"])).alias("base"),
        F.greatest(first["at"], F.coalesce("quiet", F.lit(0).cast("bigint"))).alias("lo"),
        (last["at"] + F.length(last["text"])).alias("hi"), text.alias("text"))


def _context(plans: list[_Plan]) -> int:
    """Bytes to the left of an end that a match of any of the rules can hold."""
    unbounded = [p for p in plans if p.unbounded and not p.cut]
    if unbounded:
        raise RuleError("a match may be of any length and hold any byte, so a stream can't be parted for it", unbounded[0].rule.ord)
    return max([0, *[p.cut.context if p.cut else p.width * (4 if p.rule.utf8 else 1) for p in plans]]) + 4


def _in_runs(plan: _Plan) -> bool:
    """Whether a rule without a length bound can be searched in stretches no match leaves."""
    return plan.unbounded and not plan.cut and bool(plan.p.cover) and not plan.rule.utf8 and not plan.allow_empty


CARRIED = "array<struct<rule:int,first:bigint,start:bigint>>"
BLOCK_KEY = ["stream_id", "epoch", "block"]
Cuts = list[tuple[int, Cut]]


def _cuts(plans: list[_Plan]) -> dict[bool, Cuts]:
    """The cuts of a rule set by view, each with the position of its rule in the set."""
    return {u: [(p.rule.ord, p.cut) for p in plans if p.cut and p.rule.utf8 == u] for u in (False, True)}


def _by_cut(blocks: DataFrame, cuts: Cuts, utf8: bool, needed: str | None) -> DataFrame:
    """A row for each block and cut whose ``needed`` text the block has, with the block as segment ``s`` and the cut as ``r``."""
    ords = F.array(*[F.lit(k) for k, _ in cuts])
    every = F.zip_with(ords, cut_rows([c for _, c in cuts]), lambda k, r: F.struct(k.alias("rule"), r.alias("r")))
    seg = F.struct("base", "lo", "hi", "text")

    def rows(s: Column) -> Column:
        wanted = F.filter(every, lambda x: s["text"].contains(x["r"][needed])) if needed else every
        return F.transform(wanted, lambda x: F.struct(s.alias("s"), x["rule"].alias("rule"), x["r"].alias("r")))

    kept = [c for c in blocks.columns if c not in ("base", "lo", "hi", "text")]
    return blocks.select(*kept, F.inline(S.let(_as_characters(seg) if utf8 else seg, rows)))


def _block_states(blocks: DataFrame, cuts: Cuts, utf8: bool, placed: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """What blocks do to the stretches of each cut, and the first head of every stretch.

    Blocks a stretch passes through count with the last block that breaks it (``after``), so its head is the earliest of that
    group: sums and minima over a few numbers a block, whatever the length of the stream. A saved state stands before its
    stream's first block.
    """
    stopped = blocks.where("lo < hi").withColumn("stop", F.least("hi", F.col("base") + F.length("text")))
    rows = _by_cut(stopped, cuts, utf8, None)
    rows = rows.select(*BLOCK_KEY, "rule", block_state(F.col("s"), F.col("stop"), F.col("r"), utf8).alias("x"))
    # a few numbers a block, read several times below: written, so that blocks are searched for heads once
    rows = stored(rows.select(*BLOCK_KEY, "rule", "x.passes", "x.first", "x.start"), "stretches")
    if "carried" in placed.columns:
        before = F.floor((F.col("off") + F.octet_length("data")) / size) - 1
        saved = placed.where("silent").select("stream_id", "epoch", before.alias("block"), F.inline("carried"))
        saved = saved.where(F.col("rule").isin([k for k, _ in cuts]))
        rows = rows.unionByName(saved.select(*BLOCK_KEY, "rule", F.lit(False).alias("passes"), "first", "start"))
    keys = ["stream_id", "epoch", "rule"]
    breaks = (~F.col("passes")).cast("bigint")
    # a saved state may stand at -1
    rows = running_before(rows.withColumn("at", F.col("block") + 1), keys, "at", {"before": breaks}).drop("at")
    rows = rows.withColumn("after", F.col("before") + breaks)
    heads = rows.where("first IS NOT NULL").groupBy(*keys, "after").agg(F.min(F.struct("block", "first", "start")).alias("head"))
    return rows, heads


def _cut_scan(blocks: DataFrame, cuts: Cuts, utf8: bool, placed: DataFrame, size: int, limit: int | None) -> DataFrame:
    """Events of cuts over whole streams; blocks may say whether their epoch is ``open``. Starts beyond the limit are -1."""
    rows, heads = _block_states(blocks, cuts, utf8, placed, size)
    into = rows.join(heads.withColumnRenamed("after", "before"), ["stream_id", "epoch", "rule", "before"])
    into = into.where(F.col("head.block") < F.col("block"))
    known = into.groupBy(*BLOCK_KEY).agg(F.map_from_entries(F.collect_list(F.struct("rule", "head"))).alias("known"))
    found = _by_cut(blocks.join(known, BLOCK_KEY, "left"), cuts, utf8, "tail_needed")

    open_end = F.col("open") if "open" in blocks.columns else None
    every = S.let(F.element_at("known", F.col("rule")), lambda h: cut_events(
        F.col("s"), F.col("r"), utf8, open_end, h["first"], h["start"]))
    if limit is not None:
        every = F.transform(every, lambda e: e.withField("from", F.when(
            F.col("r.report_som") & (e["to"] - e["from"] > limit), F.lit(-1).cast("bigint")).otherwise(e["from"])))
    return found.select("stream_id", "epoch", F.inline(every))


def _combined(chunks: DataFrame, plain: list[Rule], combos: list[Combination], close: bool, size: int) -> DataFrame:
    """Events of combinations: ``(stream_id, epoch, pattern_id, from, to)``, one an epoch whose rules' first ends satisfy it.

    First ends are a row for each epoch and rule, reduced in every block before they are shuffled. While an epoch is open, a
    combination that negates a rule is not yet known.
    """
    ids = sorted(set().union(*[c.ids for c in combos]))
    needed = [replace(r, flags=(r.flags - {"Q", "L"}) | {"H"}) for r in plain if r.pattern_id in ids]
    firsts = stream_scan(chunks, needed, close=close, size=size, epochs=True, horizon=False)
    by_epoch = firsts.groupBy("stream_id", "epoch").agg(
        *[F.min(F.when(F.col("pattern_id") == i, F.col("to"))).alias(f"r{i}") for i in ids])
    placed = with_offsets(chunks)
    lengths = placed.groupBy("stream_id", "epoch").agg(F.max(F.col("off") + F.octet_length("data")).alias("length"))
    if not close:
        lengths = _mark_open(lengths, chunks)
    state = lengths.join(by_epoch, ["stream_id", "epoch"], "left")
    first_end = {i: F.col(f"r{i}") for i in ids}
    found = []
    for c in combos:
        holds = c.holds(first_end)
        if not close and c.ids != c.positive:
            holds = holds & ~F.col("open")
        found.append(F.when(holds, F.struct(
            F.lit(c.rule.pattern_id).cast("int").alias("pattern_id"), F.lit(0).cast("bigint").alias("from"),
            c.end(first_end, F.col("length")).alias("to"))))
    return state.select("stream_id", "epoch", F.inline(F.array_compact(F.array(*found))))


def stream_scan(
    chunks: DataFrame, rules, *, close: bool = True, size: int = STREAM_BLOCK, som: bool = False, epochs: bool = False,
    horizon: bool = True,
) -> DataFrame:
    """Matches over whole streams, those across chunk edges included: ``(stream_id, pattern_id, from, to)``.

    Rules with one unbounded class repeat are cut there: a block needs the first
    head of the stretch it begins in, which is a minimum over a few numbers a
    block. Other rules without a length bound are searched in stretches of the
    stream a match cannot leave; where any byte may be part of a match, and for
    such rules in UTF-8, they are refused. Streams are closed at their last row unless ``close`` is off; an
    epoch that is followed by a reset, or has a close row, always is. With
    ``epochs`` the epoch column stays. Starts further back than the rule set's
    horizon are reported as -1; without ``horizon`` every start is the true one.
    """
    plain, combos = split_rules(rules)
    loud = [c for c in combos if "Q" not in c.rule.flags]
    if loud:
        out = _combined(chunks, plain, loud, close, size)
        if any("Q" not in r.flags for r in plain):
            out = out.unionByName(stream_scan(chunks, plain, close=close, size=size, som=som, epochs=True, horizon=horizon))
        return out if epochs else out.drop("epoch")
    limit = horizon_bytes(plain) if horizon else None
    plans = [_Plan(r, som, limit) for r in plain if "Q" not in r.flags]
    exact = [p for p in plans if _in_runs(p)]
    plans = [p for p in plans if p not in exact]
    left = _context(plans)
    cut = _cuts(plans)
    right = max([RIGHT_CONTEXT * 4, *[c.context for group in cut.values() for _, c in group]])
    size = max(size, left, right)
    placed = with_offsets(chunks)
    blocks = blocks_of(placed, left, right, size)
    plans = [p for p in plans if not p.cut]

    def run(group: list[_Plan], blocks: DataFrame) -> DataFrame:
        if not close:
            blocks = _mark_open(blocks, chunks)
        s = F.struct("base", "lo", "hi", "text")

        def events(open_end: bool) -> Column:
            def on(seg: Column) -> Column:
                raw = [p for p in group if not p.rule.utf8]
                utf = [p for p in group if p.rule.utf8]
                parts = [segment_events(seg, raw, open_end)] if raw else []
                if utf:
                    parts.append(S.let(_as_characters(seg), lambda c: segment_events(c, utf, open_end)))
                return F.concat(*parts)

            return S.let(s, on)

        found = events(False) if close else F.when(F.col("open"), events(True)).otherwise(events(False))
        return blocks.select("stream_id", "epoch", F.inline(found))

    def found(first_only: bool) -> DataFrame | None:
        group = [p for p in plans if p.first_only == first_only]
        parts = [run(group, blocks)] if group else []
        parts += [run([p], _whole_runs(blocks, p, size)) for p in exact if p.first_only == first_only]
        for utf8, every in cut.items():
            group = [(k, c) for k, c in every if c.once == first_only]
            if group:
                parts.append(_cut_scan(blocks if close else _mark_open(blocks, chunks), group, utf8, placed, size, limit))
        return reduce(DataFrame.unionByName, parts) if parts else None

    out, once = found(False), found(True)
    if once is not None:
        # one row per block is left of a single-match rule; the earliest of them is its event
        least = once.groupBy("stream_id", "epoch", "pattern_id").agg(F.min(F.struct("to", "from")).alias("m"))
        least = least.select("stream_id", "epoch", "pattern_id", F.col("m.from"), F.col("m.to"))
        out = least if out is None else out.unionByName(least)
    return out if epochs else out.drop("epoch")


def _mark_open(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Whether the block's epoch is still being written: the last one of a stream without a close row."""
    if "control" not in chunks.columns:
        return blocks.withColumn("open", F.lit(True))
    opens = F.coalesce(F.col("control").isin(RESET, RESTORE), F.lit(False)).cast("bigint")
    closes = F.max(F.when(F.col("control") == CLOSE, F.col("seq")))
    opened = F.max(F.when(opens == 1, F.col("seq")))
    state = chunks.groupBy("stream_id").agg(F.sum(opens).alias("last"), closes.alias("c"), opened.alias("o"))
    state = state.select("stream_id", "last", (F.col("c").isNotNull() & (F.col("c") > F.coalesce("o", F.lit(-1)))).alias("closed"))
    joined = blocks.join(state, "stream_id")
    return joined.withColumn("open", (F.col("epoch") == F.col("last")) & ~F.col("closed")).drop("last", "closed")


def carry(chunks: DataFrame, rules, *, size: int = STREAM_BLOCK, cut: bool = True) -> DataFrame:
    """State to resume from, saved in the shared folder: ``(stream_id, offset, tail[, carried])`` at the end of each stream's last epoch.

    The tail is all a later match of the rules can hold of the bytes so far: the
    longest bounded match. Of a rule that is cut at its unbounded repeat, the
    first head of the stretch that goes on is two numbers in ``carried``, a column
    that is there if a rule is cut; for
    other rules without a bound the tail holds the characters at the end that a
    match may go on from. Without ``cut`` it does so for all, as a live stream
    that goes on from the state needs.
    """
    plain, _ = split_rules(rules)
    plans = [_Plan(r, cut=cut) for r in plain]
    exact = [p for p in plans if _in_runs(p)]
    plans = [p for p in plans if p not in exact]
    keep = _context(plans)
    placed = with_offsets(chunks)
    n = F.octet_length("data")
    view = F.decode("data", "ISO-8859-1")
    # the start of the run of a rule's characters that a chunk ends with, if it doesn't fill the chunk
    runs = [n - F.length(F.regexp_extract(view, f"{p.p.flags}{p.p.cover}*+\\z", 0)) for p in exact]
    starts = [F.when((r > 0) | F.col("silent"), F.col("off") + r) for r in runs]
    ends = placed.groupBy("stream_id", "epoch").agg(
        F.max(F.col("off") + n).alias("offset"), *[F.max(s).alias(f"s{k}") for k, s in enumerate(starts)])
    last = ends.groupBy("stream_id").agg(F.max(F.struct("epoch", *[c for c in ends.columns if c not in ("stream_id", "epoch")])).alias("m"))
    least = [F.coalesce(F.col(f"m.s{k}"), F.lit(0)) - RIGHT_CONTEXT for k in range(len(exact))]
    begin = F.least(F.col("m.offset") - keep, *least) if least else F.col("m.offset") - keep
    last = last.select("stream_id", F.col("m.epoch").alias("last"), F.col("m.offset").alias("offset"), F.greatest(begin, F.lit(0)).alias("begin"))
    near = placed.join(last, "stream_id").where((F.col("epoch") == F.col("last")) & (F.col("off") + n > F.col("begin")))
    skip = F.greatest(F.col("begin") - F.col("off"), F.lit(0)).cast("int")
    piece = F.decode(F.substring(F.col("data"), skip + 1, n), "ISO-8859-1")
    grouped = near.groupBy("stream_id", F.col("epoch"), "offset").agg(F.array_sort(F.collect_list(F.struct("off", piece.alias("p")))).alias("ps"))
    text = F.array_join(F.transform("ps", lambda p: p["p"]), "")
    states = grouped.select("stream_id", "epoch", "offset", F.encode(text, "ISO-8859-1").alias("tail"))
    heads = _last_heads(placed, plans, max(size, keep))
    if heads is None:
        return stored(states.select("stream_id", "offset", "tail"), "states")
    states = states.join(heads, ["stream_id", "epoch"], "left")
    return stored(states.select("stream_id", "offset", "tail", F.col("carried").cast(CARRIED).alias("carried")), "states")


def _last_heads(placed: DataFrame, plans: list[_Plan], size: int) -> DataFrame | None:
    """First heads of the stretches that go on at the end of each epoch: ``(stream_id, epoch, carried)``."""
    cut = _cuts(plans)
    every = [c for group in cut.values() for _, c in group]
    if not every:
        return None
    context = max(c.context for c in every) + 4
    blocks = blocks_of(placed, context, context, max(size, context))
    parts = []
    for utf8, group in cut.items():
        if group:
            rows, heads = _block_states(blocks, group, utf8, placed, max(size, context))
            keys = ["stream_id", "epoch", "rule"]
            end = rows.groupBy(*keys).agg(F.max(F.struct("block", "after")).alias("m")).select(*keys, "m.after")
            parts.append(end.join(heads, [*keys, "after"]).select("stream_id", "epoch", F.struct(
                F.col("rule").cast("int").alias("rule"), F.col("head.first").alias("first"), F.col("head.start").alias("start")).alias("c")))
    return reduce(DataFrame.unionByName, parts).groupBy("stream_id", "epoch").agg(F.collect_list("c").alias("carried"))


def restore_rows(states: DataFrame, seq: Column) -> DataFrame:
    """Control rows that put saved states back: the stream continues from them."""
    return states.select(
        "stream_id", seq.cast("bigint").alias("seq"), F.col("tail").alias("payload"),
        F.lit(RESTORE).alias("control"), "offset", _carried_of(states))


def _carried_of(df: DataFrame) -> Column:
    return (F.col("carried") if "carried" in df.columns else F.lit(None)).cast(CARRIED).alias("carried")


def resume(chunks: DataFrame, states: DataFrame) -> DataFrame:
    """Chunks that continue saved streams: each stream's state goes before its first chunk."""
    shifted = _controlled(chunks).withColumn("seq", F.col("seq") + 1)
    return restore_rows(states, F.lit(0)).unionByName(shifted)


def rewind(chunks: DataFrame, states: DataFrame, at: Column) -> DataFrame:
    """Chunks with each stream put back to its saved state before position ``at``."""
    rows = _controlled(chunks).withColumn("seq", F.col("seq") * 2 + 1)
    return rows.unionByName(restore_rows(states, at * 2))


def fork(chunks: DataFrame, states: DataFrame, children: DataFrame) -> DataFrame:
    """Child streams that start as copies: ``children`` is ``(stream_id, parent_id)``.

    The parent's state, not its data, is copied; a child's own rows follow. A
    child that already has rows is reset by the copy, as a restore row does.
    """
    copies = children.join(states.withColumnRenamed("stream_id", "parent_id"), "parent_id").drop("parent_id")
    return resume(chunks, copies)


def _controlled(chunks: DataFrame) -> DataFrame:
    names = set(chunks.columns)
    return chunks.select(
        "stream_id", F.col("seq").cast("bigint").alias("seq"), F.col("payload").cast("binary").alias("payload"),
        (F.col("control") if "control" in names else F.lit(None)).cast("string").alias("control"),
        (F.col("offset") if "offset" in names else F.lit(None)).cast("bigint").alias("offset"), _carried_of(chunks),
    )
