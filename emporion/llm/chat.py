"""Chat formatting with typed content parts.

A message is a list of typed parts: ``text``, ``image``, ``audio`` or
``document``.  A visitor walks the parts and flattens them into one string: text
is escaped and copied, an attachment becomes an ordered placeholder
``<|image:0|>`` whose number counts the attachments of that message.  The
attachment's reference and the number of tokens it expands to are recorded
beside the string, so the message can be rebuilt from it exactly.

One formatted row per message is the output file: ``<|role:NAME|>``, a newline,
the flattened parts, ``<|end|>`` and a newline.  A conversation is its rows in
order of (turn, role, text); it is never gathered into one cell, so a very long
conversation costs no memory, when it is formatted or when it is read back.

Defined results: a null text or part list is an empty message; a null role is
written as an empty role; a null turn comes first; repeated rows are each kept;
an empty table gives none; other columns are ignored; a null ``conv_id`` is a
conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("text", "image", "audio", "document")
PART = "struct<type: string, text: string, ref: string, size: long>"
PARTS = f"array<{PART}>"
#: attachment kinds by the ending of a link inside plain text
ENDINGS = {"image": "png|jpe?g|gif|webp", "audio": "wav|mp3|flac|ogg", "document": "pdf|docx?|pptx?"}
_LINK = re.compile(r"https?://[^\s<>|]+?\.(?:" + "|".join(f"(?P<{k}>{v})" for k, v in ENDINGS.items()) + r")(?![A-Za-z0-9_])")
_PLACE = re.compile(r"<\|(image|audio|document):(\d+)\|>")
#: control strings of this and of other common templates; escaped inside texts
_CONTROL = (("&", "&amp;"), ("<|", "&lt;|"), ("|>", "|&gt;"), ("</s>", "&lt;/s>"), ("<s>", "&lt;s>"),
            ("[INST]", "&#91;INST]"), ("[/INST]", "&#91;/INST]"))
_CODES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&#91;": "["}
_CODE = re.compile("|".join(map(re.escape, _CODES)))
END = "<|end|>\n"


def escape(text: str) -> str:
    for plain, safe in _CONTROL:
        text = text.replace(plain, safe)
    return text


def unescape(text: str) -> str:
    return _CODE.sub(lambda m: _CODES[m[0]], text)


def parts_of(text: str) -> list[dict]:
    """Typed parts of a plain text: links to media files are attachments."""
    parts, at = [], 0
    for m in _LINK.finditer(text):
        if m.start() > at:
            parts.append({"type": "text", "text": text[at:m.start()], "ref": None, "size": None})
        parts.append({"type": m.lastgroup, "text": None, "ref": m[0], "size": None})
        at = m.end()
    if at < len(text):
        parts.append({"type": "text", "text": text[at:], "ref": None, "size": None})
    return parts


class Flatten:
    """Visitor over the parts of one message."""

    def __init__(self, tokens_per: dict[str, int]):
        self.tokens_per, self.out, self.texts, self.attachments = tokens_per, [], [], []

    def visit(self, part: dict) -> None:
        kind = part["type"] or "text"
        if kind not in KINDS:
            raise ValueError(f"unknown part type {kind!r}")
        (self.visit_text if kind == "text" else self.visit_attachment)(part, kind)

    def visit_text(self, part: dict, kind: str) -> None:
        self.texts.append(part["text"] or "")

    def flush(self) -> None:
        """Neighbouring texts are escaped as one, so that none makes a control string with the next."""
        self.out.append(escape("".join(self.texts)))
        self.texts = []

    def flattened(self) -> str:
        self.flush()
        return "".join(self.out)

    def visit_attachment(self, part: dict, kind: str) -> None:
        self.flush()
        n = len(self.attachments)
        self.out.append(f"<|{kind}:{n}|>")
        # a given size counts units (image tiles, audio seconds, document pages)
        tokens = self.tokens_per[kind] * max(1, part["size"] if part["size"] is not None else 1)
        self.attachments.append({"position": n, "type": kind, "ref": part["ref"] or "", "tokens": tokens})


#: tokens of one image tile, one second of audio, one document page
TOKENS_PER = {"image": 256, "audio": 25, "document": 512}
_ATTACHMENT = pa.struct([("position", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_SCHEMA = ("conv_id long, turn long, role string, formatted string, loss boolean, "
           "attachments array<struct<position: int, type: string, ref: string, tokens: long>>, attachment_tokens long")


def format_messages(messages: DataFrame, parts: Column | None = None, tokens_per: dict[str, int] | None = None,
                    loss_role: str = "assistant") -> DataFrame:
    """One formatted row per message of ``messages(conv_id, turn, role, text)``.
    ``parts`` may give the typed parts (array of ``PART``); without it they are
    read from the text.  ``loss`` marks rows whose content is trained on."""
    rates = {**TOKENS_PER, **(tokens_per or {})}
    cols = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role")]
    typed = parts is not None
    cols.append(parts.cast(PARTS).alias("content") if typed else F.col("text").cast("string").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, attached, tokens = [], [], []
            roles = batch.column("role").to_pylist()
            for role, content in zip(roles, batch.column("content").to_pylist()):
                visitor = Flatten(rates)
                for part in (content or []) if typed else parts_of(content or ""):
                    visitor.visit(part)
                formatted.append(f"<|role:{escape(role)}|>\n{visitor.flattened()}{END}")
                attached.append(visitor.attachments)
                tokens.append(sum(a["tokens"] for a in visitor.attachments))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(roles, pa.string()), pa.array(formatted, pa.string()),
                 pa.array([r == loss_role for r in roles]), pa.array(attached, pa.list_(_ATTACHMENT)), pa.array(tokens, pa.int64())],
                names=["conv_id", "turn", "role", "formatted", "loss", "attachments", "attachment_tokens"])

    return messages.select(*cols).mapInArrow(run, _SCHEMA)


def parse_message(formatted: str, attachments: list[dict]) -> tuple[str, str]:
    """(role, text) of a formatted row, attachments put back as their references."""
    head, sep, body = formatted.partition("|>\n")
    if not (sep and head.startswith("<|role:") and body.endswith(END)):
        raise ValueError("not a formatted message")
    refs = {a["position"]: a["ref"] for a in attachments}
    body, out, at = body[:-len(END)], [], 0
    for m in _PLACE.finditer(body):
        out += [unescape(body[at:m.start()]), refs[int(m[2])]]
        at = m.end()
    return unescape(head[len("<|role:"):]), "".join([*out, unescape(body[at:])])


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.  Rows stream through in order;
    a task holds one message at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def close(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for conv, loss, text, attached in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "loss", "formatted", "attachments"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(close(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, plain = parse_message(text, attached or [])
                state[1] += 1
                state[2].update(f"{role}\n{plain}\n".encode())
                if loss:
                    state[3] += len(plain)
                    state[4].update(plain.encode())
                state[5] += len(text)
            if done:
                yield batch_of(done)
                done = []
        if state is not None:
            yield batch_of([close(state)])

    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
            .select("conv_id", "loss", "formatted", "attachments")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
