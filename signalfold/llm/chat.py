"""Chat formatting with a prefix tree: what conversations share from their start is emitted once.

Conversations with the same first turn form a tree of turns. A tree is written depth-first as one pack of text: each
distinct turn once, after its parent and all of the parent's earlier subtrees. A node carries the position its first
token has in its own conversation and the intervals of the pack it may attend to: its ancestors. A
conversation is the path to its last turn.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts every ``<`` + backslashes + ``|`` gets one more backslash, so no
control string can occur there, and taking one away restores the text. In roles, backslashes and newlines are
escaped first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.grouped import group_runs
from signalfold.llm.tokens import Encoder, encoder

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")

_SPAN = "struct<lo:long,hi:long>"
PACKS = (
    "root long, salt long, text string, tokens binary, "
    f"nodes array<struct<parent:int,lo:long,hi:long,token_lo:long,token_hi:long,position:long,attends:array<{_SPAN}>,loss:{_SPAN}>>, "
    "conversations array<struct<c1:long,c2:long,leaf:int>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class _Turn:
    role: str = ""
    text: str = ""
    below: dict[tuple[str, str], _Turn] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)


def _emit(tree: _Turn, codec: Encoder) -> tuple[str, bytes, list[dict], list[dict]]:
    """The pack of a tree, depth-first without recursion: a conversation may have any number of turns."""
    texts, tokens, nodes, leaves = [], [], [], []
    at = token_at = 0
    todo = [(turn, -1) for _, turn in sorted(tree.below.items(), reverse=True)]
    while todo:
        turn, parent = todo.pop()
        head = f"{OPEN}{escape_role(turn.role)}\n"
        body = escape(turn.text)
        text = head + body + CLOSE
        ids = codec.ids(text)
        above = nodes[parent] if parent >= 0 else None
        attends = []
        if above:
            attends = [dict(s) for s in above["attends"]]
            if attends and attends[-1]["hi"] == above["token_lo"]:
                attends[-1]["hi"] = above["token_hi"]
            else:
                attends.append({"lo": above["token_lo"], "hi": above["token_hi"]})
        loss = {"lo": at + len(head), "hi": at + len(head) + len(body)} if turn.role == "assistant" else None
        nodes.append(
            {
                "parent": parent, "lo": at, "hi": at + len(text), "token_lo": token_at, "token_hi": token_at + len(ids),
                "position": sum(s["hi"] - s["lo"] for s in attends), "attends": attends, "loss": loss,
            }
        )
        me = len(nodes) - 1
        leaves += [{"c1": a, "c2": b, "leaf": me} for a, b in turn.ends]
        todo += [(t, me) for _, t in sorted(turn.below.items(), reverse=True)]
        texts.append(text)
        tokens.append(ids.tobytes())
        at, token_at = at + len(text), token_at + len(ids)
    return "".join(texts), b"".join(tokens), nodes, leaves


def _packer(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        for part in group_runs(batches, 2):
            tree = _Turn()
            for c1, c2, turns in zip(*(part.column(c).to_pylist() for c in ("c1", "c2", "turns")), strict=True):
                node = tree
                for t in turns:
                    node = node.below.setdefault((t["role"], t["text"]), _Turn(t["role"], t["text"]))
                node.ends.append((c1, c2))
            text, tokens, nodes, leaves = _emit(tree, codec)
            span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
            node_type = pa.struct(
                [("parent", pa.int32()), *((n, pa.int64()) for n in ("lo", "hi", "token_lo", "token_hi", "position")), ("attends", pa.list_(span)), ("loss", span)]
            )
            leaf_type = pa.struct([("c1", pa.int64()), ("c2", pa.int64()), ("leaf", pa.int32())])
            yield pa.record_batch(
                [
                    part.column("root")[:1].combine_chunks(), part.column("salt")[:1].combine_chunks(), pa.array([text]), pa.array([tokens], pa.binary()),
                    pa.array([nodes], pa.list_(node_type)), pa.array([leaves], pa.list_(leaf_type)),
                ],
                names=["root", "salt", "text", "tokens", "nodes", "conversations"],
            )

    return run


def conversation_table(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, c1, c2) from rows (conv_id, turn, role, text): the turns in order, and a 128-bit key of them.

    Null texts and roles are empty. Turns with the same number go by role, then text; null numbers come first. Rows with
    a null conv_id are one conversation.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    said = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return told.select("conv_id", said.alias("turns")).select(
        "conv_id", "turns", F.xxhash64("turns").alias("c1"), F.xxhash64(F.lit(17), F.size("turns"), "turns").alias("c2")
    )


def format_chats(conversations: DataFrame, tokenizer: str, pack_chars: int = 1 << 17) -> DataFrame:
    """Packs of the distinct conversations in ``conversation_table`` form.

    One row per tree, or, of a tree longer than ``pack_chars`` as its conversations stand, per share of them: a
    share repeats the turns it has in common with others, so that no tree meets in one task. Equal conversations
    are one path. A pack has its text and tokens, its nodes (text and token intervals, first position, ancestor
    token intervals, and the text interval under the loss: the text of an assistant's turn), and the conversations
    with the node each ends in. An empty table gives no packs.
    """
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]) + 40)
    keyed = conversations.select("c1", "c2", "turns", F.xxhash64(F.element_at("turns", 1)).alias("root"), chars.alias("chars"))
    alone = keyed.dropDuplicates(["c1", "c2"])
    trees = alone.groupBy("root").agg(F.ceil(F.sum("chars") / pack_chars).alias("salts"))
    dealt = alone.join(trees, "root").select("root", F.pmod("c1", "salts").alias("salt"), "c1", "c2", "turns")
    return dealt.repartition("root", "salt").sortWithinPartitions("root", "salt").mapInArrow(_packer(tokenizer), PACKS)


def path(nodes: list[dict], leaf: int) -> list[dict]:
    """The nodes of a conversation, first turn first."""
    found = []
    while leaf >= 0:
        found.append(nodes[leaf])
        leaf = nodes[leaf]["parent"]
    return found[::-1]


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, unescaped."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest.removesuffix(CLOSE))))
    return turns


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for pack in batch.to_pylist():
            for c in pack["conversations"]:
                nodes = path(pack["nodes"], c["leaf"])
                formatted = "".join(pack["text"][n["lo"] : n["hi"]] for n in nodes)
                turns = parse(formatted)
                loss = "".join(unescape(pack["text"][n["loss"]["lo"] : n["loss"]["hi"]]) for n in nodes if n["loss"])
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((c["c1"], c["c2"], len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        names = ["c1", "c2", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_back(packs: DataFrame, conversations: DataFrame) -> DataFrame:
    """Digests of every conversation as the packs hold it: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    schema = "c1 long, c2 long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    digests = packs.select("text", "nodes", "conversations").mapInArrow(_read, schema)
    return conversations.select("conv_id", "c1", "c2").join(digests, ["c1", "c2"]).drop("c1", "c2")


def formatted_digests(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Format all conversations and read them back."""
    conversations = stored(conversation_table(rows), "conversations")
    return read_back(format_chats(conversations, tokenizer), conversations)
