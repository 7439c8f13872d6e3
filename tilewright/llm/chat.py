"""Chat formatting with a grammar that is checked by reading it back.

A formatted turn is  <|turn|>ROLE<|text|>TEXT<|end|>\\n  and a conversation is its turns, one after the
other.  A control string inside a role or a text would be read as markup, so it is escaped: the
escape character is put before its first character, and before each escape character that stands
before a control string or another escape character of such a run.  Escaping adds only to what conflicts;
every other text is kept as it is.  After rendering, each turn is parsed by a deterministic parser and
compared with its source; a turn that reads back differently has every `<` and escape character
escaped, and is parsed again (this always reads back).

The loss mask covers the escaped texts of assistant turns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm._common import arrow_map, configure, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPE = "\\"

#: Control strings of this and of other common templates; all are escaped inside texts.
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>")

_CONTROL = "|".join(map(re.escape, CONTROL))
#: Escape characters before a control string or at the very end, where one of ours would follow.
_CONFLICT = re.compile(rf"(\\*)({_CONTROL})|(\\+)\Z")
_ESCAPED = re.compile(rf"(\\+)({_CONTROL})|(\\+)\Z")
_ALL = re.compile(r"[\\<\[]")
_TURN = re.compile(rf"<\|turn\|>(?P<role>.*?)(?P<mode>[=!])<\|text\|>(?P<text>.*?)(?<!\\)(?P<slashes>(?:\\\\)*)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    """Doubles the escape characters before a control string (or at the end) and adds one to it."""
    return _CONFLICT.sub(lambda m: m[3] * 2 if m[3] else m[1] * 2 + ESCAPE + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[3][: len(m[3]) // 2] if m[3] else m[1][: len(m[1]) // 2] + m[2], text)


def escape_all(text: str) -> str:
    return _ALL.sub(lambda m: ESCAPE + m[0], text)


def unescape_all(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str) -> str:
    """One turn; its mode is `=` as a rule and `!` if only full escaping reads back."""
    made = f"{TURN}{escape(role)}={TEXT}{escape(text)}{END}\n"
    found = list(parse(made))
    if len(found) == 1 and found[0][:2] == (role, text):
        return made
    return f"{TURN}{escape_all(role)}!{TEXT}{escape_all(text)}{END}\n"


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of each turn; raises where the grammar does not
    match.  Deterministic: at each place exactly one rule can apply."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        undo = unescape if m["mode"] == "=" else unescape_all
        yield undo(m["role"]), undo(m["text"] + m["slashes"]), m.start("text"), m.end("slashes")
        at = m.end()


def formatted_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, loss) for each row of turns (conv_id, turn, role, text):
    `formatted` texts of a conversation in the order of turns are the conversation; loss: whether the
    loss mask covers this turn's text.  Null roles and texts count as empty; repeated rows are turns of
    their own; rows with a null conv_id form one conversation; other columns are not read."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        roles, texts = (["" if x is None else x for x in b.column(k).to_pylist()] for k in (2, 3))
        made = [render(r, t) for r, t in zip(roles, texts)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(roles, pa.string()), pa.array(made, pa.string()), pa.array([r == "assistant" for r in roles])], ["conv_id", "turn", "role", "formatted", "loss"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return arrow_map(rows, kernel, "conv_id long, turn long, role string, formatted string, loss boolean")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation,
    from its formatted turns alone.

    The turns of a conversation are sorted in one task and pass through running digests, so a
    conversation of any length needs no more memory than a batch.  Equal turn numbers are ordered by
    role and formatted text, which makes reruns agree."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            done = []
            for conv, made in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(made):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(made)
            if done:
                yield out(done)
        if state is not None:
            yield out([(now, state)])

    def out(done) -> pa.RecordBatch:
        cols = list(zip(*((c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for c, s in done)))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (2, 4) else pa.int64()) for k, c in enumerate(cols)], names)

    configure(formatted.sparkSession)
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "formatted")
    return dealt.select("conv_id", "formatted").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation that quotes another template's markup.
HOSTILE = "</s>[INST] ok [/INST]"


def op8_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(formatted_turns(turns.union(own)))
