"""Chat formatting: record layouts known by a schema fingerprint, turns under an escaped template.

Instruction data comes in many layouts (turn rows, message lists, prompt and answer,
instruction and output, ...). A record's *fingerprint* is the hash of its nested field
paths, as far as any mapping names them; it selects a declarative :class:`Mapping`, which
says where the turns' roles and texts are. No code looks at field names itself. Records
of no known layout give no turns; :func:`layouts` counts records by fingerprint and tells
which are unknown.

Canonical turns are sorted within their conversation and rendered with a
:class:`Template`. Control strings inside texts are escaped (a backslash behind their
first character, backslashes doubled), so that a formatted conversation can be read
back, turn by turn; ``loss`` marks the characters of the assistant texts.

Output (Parquet): conv_id, part, formatted, loss (array of start, end: code points in
``formatted``), whole. Turns are dealt to tasks by ranges of (conversation, turn), so that a
conversation with a large share of all turns is formatted by many tasks; one that
crosses a range or is longer than ``PART_CHARS`` goes in several parts, cut between turns,
whose texts joined in order of ``part`` are the conversation. Tasks hold one part at a
time. Only a digest of a whole conversation has to read its parts one after the other.

Defined cases: NULL texts are empty, NULL roles are the empty role; roles other than
system, user and assistant are kept under their own name. Turns are ordered by turn
number (NULL first), then role and text; repeated rows are repeated turns. Rows with
a NULL conv_id are one conversation. Columns that no mapping names are ignored, also if
their names clash with the output's.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

PART_CHARS = 1 << 20
TURNS = "conv_id bigint, turn bigint, place int, role string, text string"
FORMATTED = "conv_id bigint, part bigint, formatted string, loss array<struct<start:int,end:int>>, whole boolean"


# Layouts ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Turn:
    """One declared turn (or one per list element): where role and text are found.

    ``role`` is a constant if it starts with '=', else a path below ``each``; ``each`` is
    the list that holds the turns ('' for the record itself). Without ``keep_empty`` a
    turn whose text is missing, NULL or empty is left out. ``more`` is a second text,
    joined by an empty line.
    """
    role: str
    text: str
    each: str = ""
    keep_empty: bool = False
    more: str = ""


@dataclass(frozen=True)
class Mapping:
    name: str
    turns: tuple[Turn, ...]
    optional: tuple[str, ...] = ()
    turn_number: str = ""          # rows of a conversation: the field that orders them

    def paths(self) -> set[str]:
        """All field paths the mapping reads."""
        out = {self.turn_number} if self.turn_number else set()
        for t in self.turns:
            stem = f"{t.each}[]." if t.each else ""
            out |= {t.each} | {stem + p for p in (t.text, t.more, "" if t.role[0] == "=" else t.role) if p}
        return out - {""}

    def shapes(self):
        """The path sets a record of this layout may show: everything, less any optional paths
        (what is inside a list is missing when the list is empty)."""
        every = self.paths()
        free = set(self.optional) | {p for p in every if "[]." in p}
        for n in range(len(free) + 1):
            for gone in itertools.combinations(sorted(free), n):
                yield frozenset(every - set(gone))


#: Names other tools give to the three roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
         "chatgpt": "assistant"}

#: The layouts in use, and where their turns are. The first that fits wins.
MAPPINGS = (
    Mapping("turn rows", (Turn("role", "text", keep_empty=True),), turn_number="turn"),
    Mapping("messages", (Turn("role", "content", "messages", True),)),
    Mapping("conversations from-value", (Turn("from", "value", "conversations", True),)),
    Mapping("conversations role-content", (Turn("role", "content", "conversations", True),)),
    Mapping("system and conversations", (Turn("=system", "system"), Turn("from", "value", "conversations", True))),
    Mapping("instruction", (Turn("=system", "system"), Turn("=user", "instruction", more="input"),
                            Turn("=assistant", "output", keep_empty=True)), ("system", "input")),
    Mapping("prompt and completion", (Turn("=system", "system"), Turn("=user", "prompt"),
                                      Turn("=assistant", "completion", keep_empty=True)), ("system",)),
    Mapping("prompt and response", (Turn("=system", "system_prompt"), Turn("=user", "prompt"),
                                    Turn("=assistant", "response", keep_empty=True)), ("system_prompt",)),
    Mapping("question and answer", (Turn("=user", "question", more="context"),
                                    Turn("=assistant", "answer", keep_empty=True)), ("context",)),
    Mapping("prompt messages and completion", (Turn("role", "content", "prompt", True),
                                               Turn("=assistant", "completion", keep_empty=True))),
    Mapping("chosen", (Turn("role", "content", "chosen", True),)),
)


@functools.cache
def vocabulary() -> frozenset[str]:
    return frozenset(p for m in MAPPINGS for p in m.paths())


def paths(record, vocabulary: frozenset[str]) -> frozenset[str]:
    """The record's nested field paths that are in the vocabulary. 'a' is a field that is there
    (NULL or not), 'a[].b' a field of a list's elements; a list that is read as one text counts as 'a'."""
    found = set()
    for name, value in record.items():
        if name in vocabulary:
            found.add(name)
        if isinstance(value, list):
            for element in value:
                if isinstance(element, dict):
                    found.update(p for p in (f"{name}[].{k}" for k in element) if p in vocabulary)
    return frozenset(found)


def fingerprint(shape: frozenset[str]) -> str:
    """128-bit hash of a set of field paths."""
    return hashlib.blake2b("\n".join(sorted(shape)).encode(), digest_size=16).hexdigest()


@functools.cache
def selection() -> dict[str, Mapping]:
    """Fingerprint -> mapping, for all shapes of all layouts."""
    out: dict[str, Mapping] = {}
    for m in MAPPINGS:
        for shape in m.shapes():
            if any(p in shape for p in m.paths() if "[]." not in p):
                out.setdefault(fingerprint(shape), m)
    return out


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) of a record, as its mapping declares."""
    out = []
    for t in mapping.turns:
        for item in (record.get(t.each) or []) if t.each else [record]:
            if not isinstance(item, dict):
                continue
            role = t.role[1:] if t.role[0] == "=" else _text(item.get(t.role))
            text = "\n\n".join(x for x in (_text(item.get(t.text)), _text(item.get(t.more)) if t.more else "") if x)
            if text or t.keep_empty:
                out.append((ROLES.get(role, role), text))
    return out


def _records(frame: DataFrame, key: str, column: str | None) -> DataFrame:
    """conv_id and the record as JSON: of a JSON text column, or of the frame's own fields that mappings name."""
    if column:
        return frame.select(F.col(key).cast("bigint").alias("conv_id"), F.col(column).alias("record"))
    roots = {p.split("[]")[0] for p in vocabulary()}
    fields = [F.col(f"`{c}`") for c in frame.columns if c in roots]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}) if fields else F.lit("{}")
    return frame.select(F.col(key).cast("bigint").alias("conv_id"), body.alias("record"))


def _parsed(batches):
    """(conv_id, record, fingerprint) per row; text that is no JSON object has no fields."""
    known: dict[frozenset, str] = {}
    for b in batches:
        for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            try:
                record = json.loads(raw) if raw else {}
            except ValueError:
                record = {}
            record = record if isinstance(record, dict) else {}
            shape = paths(record, vocabulary())
            if shape not in known:
                known[shape] = fingerprint(shape)
            yield key, record, known[shape]


def turns(frame: DataFrame, key: str = "conv_id", column: str | None = None) -> DataFrame:
    """Canonical turns (``TURNS``) of records in any known layout: rows of a typed frame, or JSON
    objects in ``column``. A record is one conversation, or one turn of it where its layout says so."""
    def run(batches):
        chosen = selection()
        for b in batches:
            rows = []
            for conv, record, mark in _parsed([b]):
                m = chosen.get(mark)
                number = record.get(m.turn_number) if m and m.turn_number else None
                for i, (role, text) in enumerate(turns_of(record, m) if m else []):
                    rows.append((conv, number, i, role, text))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))],
                [c.split()[0] for c in TURNS.split(", ")])
    return _records(frame, key, column).mapInArrow(run, TURNS)


def layouts(frame: DataFrame, key: str = "conv_id", column: str | None = None) -> DataFrame:
    """fingerprint, layout (NULL: unknown), n: how many records have which layout."""
    def run(batches):
        count: dict[str, int] = {}
        for _, _, mark in _parsed(batches):
            count[mark] = count.get(mark, 0) + 1
        names = [selection()[k].name if k in selection() else None for k in count]
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(names, pa.string()),
                                          pa.array(list(count.values()), pa.int64())], ["fingerprint", "layout", "n"])
    rows = _records(frame, key, column).mapInArrow(run, "fingerprint string, layout string, n bigint")
    return rows.groupBy("fingerprint", "layout").agg(F.sum("n").alias("n"))


# Templates -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Template:
    """Marks around the texts of each role. ``other`` opens any other role, whose escaped
    name stands between its two marks. Control strings are what marks have in <...> or [...];
    no mark contains a backslash."""
    name: str
    marks: dict = field(hash=False)
    other: tuple[str, str, str]

    @functools.cached_property
    def control(self) -> list[str]:
        every = " ".join([*(m for pair in self.marks.values() for m in pair), *self.other])
        return sorted(set(re.findall(r"<\S*?>+|\[\S*?\]", every)), key=lambda m: (-len(m), m))

    @functools.cached_property
    def _break(self) -> re.Pattern:
        """The first character of every control string, wherever one starts."""
        return re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.control))

    def escape(self, text: str) -> str:
        return self._break.sub(lambda m: m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn's segment, and where its text begins and ends in it."""
        body = self.escape(text)
        if role in self.marks:
            head, tail = self.marks[role]
        else:
            head, tail = self.other[0] + self.escape(role) + self.other[1], self.other[2]
        return head + body + tail, len(head), len(head) + len(body)

    @functools.cached_property
    def _segment(self) -> re.Pattern:
        known = [f"(?:{re.escape(h)}(?P<r{i}>.*?){re.escape(t)})" for i, (h, t) in enumerate(self.marks.values())]
        o = [re.escape(x) for x in self.other]
        return re.compile("|".join([*known, f"(?:{o[0]}(?P<name>.*?){o[1]}(?P<other>.*?){o[2]})"]), re.S)

    def parse(self, formatted: str):
        """(role, text, start, end) of each turn; the escaped text is formatted[start:end]."""
        roles, at = list(self.marks), 0
        while at < len(formatted):
            m = self._segment.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            group = m.lastgroup
            role = self.unescape(m["name"]) if group == "other" else roles[int(group[1:])]
            yield role, self.unescape(m[group]), m.start(group), m.end(group)
            at = m.end()


#: Marks of two common templates. A turn's closing mark ends it whatever follows.
INST = Template("inst", {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"),
                         "assistant": ("<s>", "</s>\n")}, ("[ROLE]", "[/ROLE]", "[/TURN]\n"))
CHATML = Template("chatml", {r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ("system", "user", "assistant")},
                  ("<|im_name|>", "<|im_sep|>", "<|im_end|>\n"))
TEMPLATES = {t.name: t for t in (INST, CHATML)}


def formatted(canonical: DataFrame, template: str = "inst", part_chars: int | None = None) -> DataFrame:
    """``FORMATTED`` of canonical turns. One shuffle by conversation; a task holds one part."""
    limit = part_chars or PART_CHARS

    def run(batches):
        style = TEMPLATES[template]
        key, texts, spans, size = None, [], [], 0
        part = TaskContext.get().partitionId() << 32
        whole = False                # a task's first and last conversation may go on in another
        out: list[tuple] = []

        def batch():
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.string(), span, pa.bool_()))], [
                    "conv_id", "part", "formatted", "loss", "whole"])
            out.clear()
            return made
        held = 0
        for b in batches:
            for conv, role, text in zip(*[b.column(i).to_pylist() for i in (0, 3, 4)]):
                segment, start, end = style.render(role, text)
                if texts and (conv != key or size + len(segment) > limit):
                    out.append((key, part, "".join(texts), spans, whole and conv != key))
                    whole, part, held = conv != key, part + 1, held + size
                    texts, spans, size = [], [], 0
                    if held >= limit:
                        yield batch()
                        held = 0
                key = conv
                texts.append(segment)
                if role == "assistant":
                    spans.append({"start": size + start, "end": size + end})
                size += len(segment)
        if texts:
            out.append((key, part, "".join(texts), spans, False))
            yield batch()
    order = ["conv_id", F.col("turn").asc_nulls_first(), "place", "role", "text"]
    rows = canonical.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    return rows.mapInArrow(run, FORMATTED)


def _digests(template: str):
    """Digests of conversations whose parts come one after the other; one part is held at a time."""
    def run(batches):
        style = TEMPLATES[template]
        state = None
        rows: list[tuple] = []

        def close():
            key, n, sha, loss, loss_sha, chars = state
            rows.append((key, n, sha.hexdigest(), loss, loss_sha.hexdigest(), chars))
        for b in batches:
            for key, _, text, spans in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if not state or key != state[0]:
                    if state:
                        close()
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in style.parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = style.unescape(text[s["start"]:s["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if rows:
                yield _digest_batch(rows)
                rows.clear()
        if state:
            close()
            yield _digest_batch(rows)
    return run


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if " string" in c else pa.int64() for c in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      [c.split()[0] for c in DIGESTS.split(", ")])


def digests(spark: SparkSession, path: str, template: str = "inst") -> DataFrame:
    """``DIGESTS`` of a written output, read back through the template. Only conversations in
    several parts are brought together again; their digest is a pass over the parts in order."""
    rows = spark.read.schema(FORMATTED).parquet(path)
    short = rows.where("whole").select("conv_id", "part", "formatted", "loss")
    long = rows.where("not whole").select("conv_id", "part", "formatted", "loss")
    long = long.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return short.mapInArrow(_digests(template), DIGESTS).union(long.mapInArrow(_digests(template), DIGESTS))


#: The conversation that the query adds to the table.
EXTRA = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    fields = ["conv_id", "turn", "role", "text"]
    extra = spark.createDataFrame(EXTRA, "conv_id bigint, turn bigint, role string, text string")
    path = scratch_path(spark, "chat")
    formatted(turns(conversations.select(*fields).union(extra))).write.option("compression", "zstd").parquet(path)
    return digests(spark, path)


_MARKS = {r: len(h) + len(t) for r, (h, t) in INST.marks.items()}
_OTHER = sum(map(len, INST.other))
_SQL_BREAK = "|".join(c.replace("[", r"\[").replace("]", r"\]") for c in INST.control)
SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\|{_SQL_BREAK}')) AS body,
    CASE role {' '.join(f"WHEN '{r}' THEN {n}" for r, n in _MARKS.items())}
      ELSE {_OTHER} + length(role) + len(regexp_extract_all(role, '\\|{_SQL_BREAK}')) END AS marks FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(body + marks) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
