"""Chat formatting by prefix-target expansion: every assistant turn becomes an
example of its own, with all preceding turns as context and only that reply
trainable.

:func:`expand` cuts a conversation into steps in one pass. A step holds what is
new in an example: ``delta``, the formatted turns since the previous example, and
``target``, the formatted reply up to its end mark. ``since`` is where the previous
example ends, ``loss_start`` and ``loss_end`` frame the reply, all in code points
of the full text. Turns after the last reply are a last example without target.
Where more than PART characters of turns come before a reply, they leave in
steps of their own (target null, same ``example``, ``part`` counts up).
``context_sha256`` is the digest of an example's whole context, every turn before
and the opening of the reply.

:func:`whole` makes the examples of the steps, each with its whole context. A
context longer than PART characters takes several rows (``part``), the last of
which (``final``) has the target; their length is the square of a conversation's by
nature, but no row and no task's memory grows with it: a conversation is dealt in
blocks of PART characters, and a block's examples are written while the turns
before the block stream by. :func:`read_examples` takes the turns and the trainable
text out of these rows, and fails if an example's context, target or span is not
what the examples before it give.

A turn is ``<s>role[INST]text</s>``. Where a role or text has an opening bracket
followed by backslashes and the rest of a control string, one more backslash
goes in; taking one out again restores it exactly.

Defined results: turns go by turn number (null first), then role, then text, so
ties and repeated rows have a fixed order; null text and role read as empty; a
null conversation id is a conversation of its own. An empty table gives an
empty result. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# The control strings of the template and those escaped besides.
BOS, INST, EOS = "<s>", "[INST]", "</s>"
_OPEN = re.compile(r"<\\*(?=/?s>|</?SYS>>)|\[\\*(?=/?INST\])")
_ESCAPED = re.compile(r"<\\+(?=/?s>|</?SYS>>)|\[\\+(?=/?INST\])")
REPLY_ROLE = "assistant"
PART = 1 << 20          # characters of turns after which a row ends
_CHUNK = 2000
_CHUNK_CHARS = 1 << 24


def escape(text: str) -> str:
    return _OPEN.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0] + m.group()[2:], text)


def format_turn(role: str, text: str) -> str:
    return f"{BOS}{escape(role)}{INST}{escape(text)}{EOS}"


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(formatted):
        mid = formatted.index(INST, at)
        end = formatted.index(EOS, mid)
        out.append((unescape(formatted[at + len(BOS):mid]), unescape(formatted[mid + len(INST):end])))
        at = end + len(EOS)
    return out


_EXAMPLE = ("conv_id long, example long, part long, n_context_turns long, delta string, target string, "
            "since long, loss_start long, loss_end long, context_sha256 string")
_EXAMPLE_NAMES = ["conv_id", "example", "part", "n_context_turns", "delta", "target", "since", "loss_start", "loss_end",
                  "context_sha256"]
_TEXTS = ("delta", "context", "target", "context_sha256", "turns_sha256", "loss_sha256")


def _record_batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    types = {**dict.fromkeys(_TEXTS, pa.string()), "final": pa.bool_()}
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))),
                                      schema=pa.schema([(n, types.get(n, pa.int64())) for n in names]))


def _expand(batches):
    """Over turns sorted by conversation: one running conversation at a time,
    holding only the turns since its last row."""
    conv, open_ = None, False
    example = part = turns = chars = since = waiting = held = 0
    prefix = hashlib.sha256()
    delta: list[str] = []
    rows: list[tuple] = []

    def unanswered():
        text = "".join(delta)
        rows.append((conv, example, part, turns, text, None, since, chars + len(text), chars + len(text), None))
        return len(text)

    def flush():
        return _record_batch(_EXAMPLE_NAMES, rows)

    for b in batches:
        for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            if not open_ or c != conv:
                if delta:
                    held += unanswered()
                conv, open_, example, part, turns, chars, since, waiting, delta = c, True, 0, 0, 0, 0, 0, 0, []
                prefix = hashlib.sha256()
            turns += 1
            if role == REPLY_ROLE:
                opening, target = f"{BOS}{escape(role)}{INST}", escape(text) + EOS
                context = "".join(delta) + opening
                prefix.update(opening.encode())
                start = chars + len(context)
                rows.append((conv, example, part, turns - 1, context, target, since, start, start + len(target) - len(EOS),
                             prefix.hexdigest()))
                prefix.update(target.encode())
                held += len(context) + len(target)
                chars, example, part, waiting, delta = start + len(target), example + 1, 0, 0, []
                since = chars
            else:
                delta.append(format_turn(role, text))
                prefix.update(delta[-1].encode())
                waiting += len(delta[-1])
                if waiting >= PART:
                    held += unanswered()
                    chars, part, waiting, delta = chars + waiting, part + 1, 0, []
            if len(rows) >= _CHUNK or held >= _CHUNK_CHARS:
                yield flush()
                rows, held = [], 0
    if delta:
        unanswered()
    if rows:
        yield flush()


def expand(turns: DataFrame) -> DataFrame:
    """Steps of ``conv_id, turn, role, text`` rows. Each task streams over
    its sorted turns; nothing is gathered per conversation."""
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_expand, _EXAMPLE))


def render(examples: DataFrame) -> DataFrame:
    """``conv_id, example, text, loss_start, loss_end`` with the full texts; the
    output is as long as the contexts are, the square of a conversation."""
    order = Window.partitionBy("conv_id").orderBy("example", "part")
    w = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = examples.withColumn("_last", ~F.lead("example").over(order).eqNullSafe(F.col("example")))
    return whole.select(
        "conv_id", "example", F.array_join(F.collect_list(F.concat("delta", F.coalesce("target", F.lit("")))).over(w), "")
        .alias("text"), "loss_start", "loss_end", "_last").where("_last").drop("_last")


_WHOLE_NAMES = ["conv_id", "example", "part", "context", "target", "final", "since", "loss_start", "loss_end",
                "context_sha256"]
_WHOLE = ("conv_id long, example long, part long, context string, target string, final boolean, since long, "
          "loss_start long, loss_end long, context_sha256 string")


def _contexts(batches):
    """Over steps sorted by conversation and block, the block's own steps first,
    then those of all blocks before it: the own examples are held, the turns
    before them are written to each as they pass."""
    group, own, before, waiting, part, held = None, [], [], 0, 0, 0
    rows: list[tuple] = []

    def examples():
        """The block's examples; the last may have no target."""
        return [s for i, s in enumerate(own) if s[2] is not None or (i == len(own) - 1 and group[2])]

    def full():
        return len(rows) >= _CHUNK or held >= _CHUNK_CHARS

    def flush():
        nonlocal rows, held
        done, rows, held = rows, [], 0
        return _record_batch(_WHOLE_NAMES, done)

    def pass_on():
        nonlocal before, waiting, part, held
        text = "".join(before)
        for example, _, _, *spans in examples():
            rows.append((group[0], example, part, text, None, False, *spans))
            held += len(text)
            if full():
                yield flush()
        before, waiting, part = [], 0, part + 1

    def close():
        nonlocal held
        owned = {id(s) for s in examples()}
        text = "".join(before)
        for s in own:
            example, delta, target, *spans = s
            text += delta
            if id(s) in owned:
                rows.append((group[0], example, part, text, target, True, *spans))
                held += len(text) + len(target or "")
                if full():
                    yield flush()
            text += target or ""

    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(11)]
        for c, block, last, is_own, example, delta, target, *spans in zip(*cols):
            if group is None or (c, block) != group[:2]:
                if own:
                    yield from close()
                group, own, before, waiting, part = (c, block, last), [], [], 0, 0
            if is_own:
                own.append((example, delta, target, *spans))
            elif own:
                before.append(delta + (target or ""))
                waiting += len(before[-1])
                if waiting >= PART:
                    yield from pass_on()
    if own:
        yield from close()
    if rows:
        yield flush()


def whole(steps: DataFrame) -> DataFrame:
    """The examples with their whole contexts, from the steps of :func:`expand`."""
    steps = steps.withColumn("_block", F.floor(F.col("loss_start") / PART))
    # one row per PART characters of the table at most, so it may be broadcast
    long_ = (steps.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("_block").alias("_most")).where(F.col("_most") > 0))
    rows = steps.join(F.broadcast(long_), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn(
        "_last", F.coalesce("_most", F.lit(0).cast("long")))
    rows = rows.withColumn("_for", F.explode(F.sequence("_block", "_last")))
    rows = rows.withColumn("_own", F.col("_block") == F.col("_for")).withColumn("_end", F.col("_for") == F.col("_last"))
    return (rows.repartition("conv_id", "_for")
            .sortWithinPartitions("conv_id", "_for", F.col("_own").desc(), "example", "part")
            .select("conv_id", "_for", "_end", "_own", "example", "delta", "target", "since", "loss_start", "loss_end",
                    "context_sha256").mapInArrow(_contexts, _WHOLE))


_NEWS_NAMES = ["conv_id", "example", "part", "delta", "target", "loss_start", "loss_end", "context_sha256"]
_NEWS = ("conv_id long, example long, part long, delta string, target string, loss_start long, loss_end long, "
         "context_sha256 string")


def _news(batches):
    """Over the rows of whole examples as :func:`whole` writes them: every context
    is hashed whole, what the example has beyond the one before it goes on."""
    state: dict[tuple, list] = {}
    rows: list[tuple] = []
    held = 0
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(10)]
        for c, example, part, context, target, final, since, start, end, digest in zip(*cols):
            seen = state.setdefault((c, example), [hashlib.sha256(), 0])
            seen[0].update(context.encode())
            delta = context[max(0, since - seen[1]):]
            seen[1] += len(context)
            found = None
            if final:
                found = state.pop((c, example))[0].hexdigest()
                if seen[1] != start or (target is not None and found != digest):
                    raise ValueError(f"conversation {c}: an example's context or span differs from its rows")
            if delta or final:
                rows.append((c, example, part, delta, target, start if final else None, end if final else None, found))
                held += len(delta) + len(target or "")
            if len(rows) >= _CHUNK or held >= _CHUNK_CHARS:
                yield _record_batch(_NEWS_NAMES, rows)
                rows, held = [], 0
    if state:
        raise ValueError(f"conversation {next(iter(state))[0]}: an example's last row is missing")
    if rows:
        yield _record_batch(_NEWS_NAMES, rows)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read(batches):
    """Over what is new in each example, sorted by conversation and example. The
    digest of an example's whole context must be that of all that came before."""
    conv, open_ = None, False
    prefix = hashlib.sha256()
    state: list = []
    rows: list[tuple] = []

    def close():
        if open_:
            rows.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(6)]
        for c, delta, target, start, end, context in zip(*cols):
            if not open_ or c != conv:
                close()
                conv, open_, state, prefix = c, True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], hashlib.sha256()
            prefix.update(delta.encode())
            if context is not None:
                # the span is the reply without its end mark, and empty without one
                at = state[4] + len(delta)
                reply = len(target) - len(EOS) if target is not None else 0
                if (prefix.hexdigest(), start, end) != (context, at, at + reply):
                    raise ValueError(f"conversation {c}: an example's context or span differs from its rows")
            full = delta + (target or "")
            prefix.update((target or "").encode())
            for role, text in parse_turns(full):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if context is not None:
                # the mask's span counts from the start of the full text
                loss = unescape(full[start - state[4]:end - state[4]])
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += len(full)
            if len(rows) >= _CHUNK:
                yield _record_batch(_DIGEST_NAMES, rows)
                rows = []
    close()
    if rows:
        yield _record_batch(_DIGEST_NAMES, rows)


def read_examples(examples: DataFrame) -> DataFrame:
    """Per conversation, from the whole examples alone (rows as :func:`whole`
    leaves them): turns and trainable text, parsed and unescaped, as digests. Every
    example's whole context is checked on the way."""
    names = ["conv_id", "delta", "target", "loss_start", "loss_end", "context_sha256"]
    return (examples.select(*_WHOLE_NAMES).mapInArrow(_news, _NEWS).repartition("conv_id")
            .sortWithinPartitions("conv_id", "example", "part").select(*names).mapInArrow(_read, _DIGEST))


def read_back(steps: DataFrame) -> DataFrame:
    """The digests of the examples that the steps give."""
    return read_examples(whole(steps))
