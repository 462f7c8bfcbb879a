"""Operator 10, chat formatting by schema fingerprints. DataFrame functions only.

A record is one JSON string. Its shape is the set of its nested field paths, to any depth, with their types: `messages[].role:STRING`,
`history[][]:STRING`. They come from the schema of a variant, parsed from the record with its texts emptied and runs of equal
objects reduced to one, so the shape's size doesn't grow with texts or turns. `fingerprint` is the hash of all of them.

Layouts are declared as data: which paths may hold roles and texts. The hash of a record's telling paths selects the layout. Telling
are all paths with texts, and those that a layout names whatever they hold; numbers, flags, nulls and the declared metadata are not. So
a record with a text that its layout doesn't read has another hash and gets no layout: nothing is lost in silence.

The template marks each turn as <s>[role]text</s>. Inside roles and texts the characters that control
strings need (& < > [ ]) stand as entities, so no text can hold a mark and unescaping gives every
text back. The loss mask is a list of spans over assistant texts.

Scale: one row is one conversation; expressions only, no shuffle in the operator itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TURNS = "array<struct<role:string,text:string>>"
#: Control characters and their entities; & first, so that unescaping in reverse order is exact.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&#91;"), ("]", "&#93;"))


#: Fields that say something about a record and hold nothing that was said, at any depth and with all below them.
METADATA = ("id", "uuid", "conv_id", "conversation_id", "message_id", "parent_id", "prompt_id", "meta", "metadata", "source", "origin", "dataset", "lang", "language", "model", "timestamp", "created_at", "updated_at", "label", "tags", "category", "type")


def _subsets(names: tuple[str, ...], least: int) -> Iterator[tuple[str, ...]]:
    return (c for n in range(least, len(names) + 1) for c in combinations(names, n))


@dataclass(frozen=True)
class Layout:
    """A list of messages (`items`, a dotted path), each with a role and a text under one of the names given, or single fields: (role, field) for each turn.

    `parts`: a message's text is a list of objects, whose texts under this name follow each other. `context` names a field whose text,
    where not empty, follows that of the user after a blank line; `history` one with a list of pairs, turns of user and assistant
    before the others. `lead`: optional (role, field) whose text, where not empty, is a turn before all. `repeated`: an optional field
    that says the text of a message again.
    """

    name: str
    items: str | None = None
    role: tuple[str, ...] = ("role", "from")
    text: tuple[str, ...] = ("content", "value", "text")
    parts: str | None = None
    fields: tuple[tuple[str, str], ...] = ()
    context: str | None = None
    history: str | None = None
    lead: tuple[str, str] | None = ("system", "system")
    repeated: str | None = None

    @property
    def leaves(self) -> list[str]:
        """Paths of roles and texts, whatever they hold."""
        inside = [f"{self.items}[].{n}" for n in (*self.role, *([] if self.parts else self.text))] if self.items else [f for _, f in self.fields]
        return inside + [x for x in (self.context, self.lead and self.lead[1], self.repeated) if x]

    @property
    def prints(self) -> set[str]:
        """Joined telling paths of the records that the layout reads: any of the role names with any of the text names, with and without what is optional."""
        if self.items:
            inside = f"[].{self.parts}" if self.parts else ""
            bodies = [{f"{self.items}[].{n}" for n in r} | {f"{self.items}[].{n}{inside}" for n in t} for r in _subsets(self.role, 1) for t in _subsets(self.text, 1)]
            bodies += [] if self.parts else [{f"{self.items}[]"}]
        else:
            own = {f for _, f in self.fields} | ({self.context} if self.context else set())
            bodies = [own | {f"{self.history}{x}"} for x in ("[]", "[][]")] if self.history else [own]
        optional = tuple(x for x in (self.lead and self.lead[1], self.repeated) if x)
        return {"\n".join(sorted(body | set(more))) for body in bodies for more in _subsets(optional, 0)}

    def turns(self, record: Column) -> Column:
        """Turns of a record with one of the prints; null where a message has two roles or texts, or the repeated text stands in none."""
        plain = [f for _, f in self.fields] + [x for x in (self.context, self.lead and self.lead[1], self.repeated) if x]
        columns = [f"`{x}`:string" for x in plain] + ([f"`{self.history}`:array<array<string>>"] if self.history else [])
        if self.items:
            kind = f"array<struct<`{self.parts}`:string>>" if self.parts else "string"
            listed = f"array<struct<{','.join([f'`{n}`:string' for n in self.role] + [f'`{n}`:{kind}' for n in self.text])}>>"
            *outer, last = self.items.split(".")
            inner = f"`{last}`:{listed}"
            for x in reversed(outer):
                inner = f"`{x}`:struct<{inner}>"
            columns.append(inner)
        read = F.from_json(record, f"struct<{','.join(columns)}>", {"maxStringLen": str(2**31 - 1)})
        return F.get(F.transform(F.array(read), self._turns_of), F.lit(0))  # parsed once, however often it is named

    def _turns_of(self, r: Column) -> Column:
        turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
        whole = F.lit(True)
        if self.items:
            items = r
            for x in self.items.split("."):
                items = items[x]
            said = lambda m, n: F.array_join(F.transform(m[n], lambda p: F.coalesce(p[self.parts], F.lit(""))), "") if self.parts else m[n]
            first = lambda m, names, of: F.coalesce(*[of(m, n) for n in names])
            body = F.transform(items, lambda m: turn(first(m, self.role, lambda m, n: m[n]), first(m, self.text, said)))
            several = lambda m, names: sum((m[n].isNotNull().cast("int") for n in names), F.lit(0)) > 1
            whole = F.forall(items, lambda m: m.isNotNull() & ~several(m, self.role) & ~several(m, self.text))
            if self.repeated:
                whole = whole & (F.coalesce(r[self.repeated], F.lit("")).isin("") | F.exists(body, lambda m: m["text"].eqNullSafe(r[self.repeated])))
        else:
            own = lambda role, field: r[field] if role != "user" or not self.context else F.when(F.coalesce(r[self.context], F.lit("")) == "", r[field]).otherwise(F.concat(F.coalesce(r[field], F.lit("")), F.lit("\n\n"), r[self.context]))
            body = F.array(*[turn(F.lit(role), own(role, field)) for role, field in self.fields])
        if self.history:
            pairs = F.coalesce(r[self.history], F.array().cast("array<array<string>>"))
            whole = F.forall(pairs, lambda x: F.coalesce(F.size(x) == 2, F.lit(False)))
            body = F.concat(F.flatten(F.transform(pairs, lambda x: F.array(turn(F.lit("user"), F.get(x, F.lit(0))), turn(F.lit("assistant"), F.get(x, F.lit(1)))))), body)
        if self.lead:
            role, field = self.lead
            body = F.when(F.coalesce(r[field], F.lit("")) != "", F.concat(F.array(turn(F.lit(role), r[field])), body)).otherwise(body)
        return F.when(whole, body)


LAYOUTS = (
    Layout("question", fields=(("user", "question"), ("assistant", "answer"))),
    Layout("question_system", fields=(("system", "system_prompt"), ("user", "question"), ("assistant", "response")), lead=None),
    Layout("prompt", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", fields=(("user", "instruction"), ("assistant", "output")), context="input"),
    Layout("instruction_history", fields=(("user", "instruction"), ("assistant", "output")), history="history"),
    Layout("instruction_input_history", fields=(("user", "instruction"), ("assistant", "output")), context="input", history="history"),
    Layout("sharing", "conversations"),
    Layout("turns", "turns"),
    Layout("messages", "messages", repeated="prompt"),
    Layout("messages_parts", "messages", role=("role",), text=("content",), parts="text", repeated="prompt"),
    Layout("nested_messages", "data.messages"),
)
#: Other names of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def shape(record: Column) -> Column:
    """The schema of a record as a string, like OBJECT<id: BIGINT, turns: ARRAY<OBJECT<text: STRING>>>; null for what isn't JSON or names a field twice.

    Texts are emptied before it is parsed, then runs of equal objects reduced to one: a variant is bounded in size, records are not.
    """
    closed = F.regexp_replace(F.regexp_replace(record, r"(?s)\\.", "?"), r'"([^"]*+)"', '"$1\x01')  # no quote in a string, and its end differs from its start
    bare = F.translate(F.regexp_replace(closed, r'"[^"\x01]*+\x01(?!\s*+:)', '"\x01'), "\x01", '"')
    return F.schema_of_variant(F.try_parse_json(F.regexp_replace(bare, r"(\{[^{}\[\]]*+\},\s*+)\1++", "$1")))


TOKENS = r"OBJECT<|ARRAY<|>|[A-Z]+(?:\(\d+,\d+\))?(?=[,>]|$)|(?:`[^`]*+`|\w+): "


def field_paths(record: Column) -> Column:
    """Sorted nested field paths of a JSON value with their types: `a:STRING`, `a.b:BIGINT` in an object, `a[].b:VOID` in the objects of a list, `a[]:VARIANT` for a list of several kinds.

    Objects in a list count together. Null for what isn't JSON, names a field twice or has a backtick in a name.
    """
    schema = shape(record)
    tokens = F.regexp_extract_all(F.when(~schema.contains("``"), schema), F.lit(TOKENS), F.lit(0))
    start = F.struct(F.array(F.lit("")).alias("open"), F.lit("").alias("at"), F.array().cast("array<string>").alias("found"))

    def step(acc: Column, t: Column) -> Column:
        top, name = F.element_at(acc["open"], -1), t.endswith(": ")
        opens, listed = t.isin("OBJECT<", "ARRAY<"), F.concat(acc["at"], F.lit("[]"))
        key = F.regexp_replace(t, ": $", "")
        at = F.when(name, F.when(top == "", key).otherwise(F.concat(top, F.lit("."), key))).when(t == "ARRAY<", listed).otherwise(acc["at"])
        stack = F.when(opens, F.concat(acc["open"], F.array(at))).when(t == ">", F.slice(acc["open"], 1, F.size(acc["open"]) - 1)).otherwise(acc["open"])
        found = F.when(~name & ~opens & (t != ">"), F.concat(acc["found"], F.array(F.concat(acc["at"], F.lit(":"), t)))).otherwise(acc["found"])
        return F.struct(stack.alias("open"), at.alias("at"), found.alias("found"))

    return F.array_sort(F.aggregate(tokens, start, step, lambda acc: acc["found"]))


def fingerprint(paths: Column) -> Column:
    return F.when(paths.isNotNull(), F.xxhash64(F.array_join(paths, "\n")))


def _any_of(names) -> str:
    return "(?:" + "|".join(re.escape(n) for n in sorted(set(names))) + ")"


def telling_paths(paths: Column, layouts: tuple[Layout, ...]) -> Column:
    """The paths, without types, that hold texts or that a layout names; metadata left out."""
    named = _any_of([x for y in layouts for x in [*y.leaves, *[p for s in y.prints for p in s.split("\n")]]])
    told = F.filter(paths, lambda p: (p.rlike(r":(?:STRING|VARIANT)$") | p.rlike(rf"^{named}:")) & ~p.rlike(rf"(?:^|\.){_any_of(METADATA)}[.\[:]"))
    return F.transform(told, lambda p: F.regexp_replace(p, r":[A-Z]+(?:\(\d+,\d+\))?$", ""))


def canonical_turns(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records plus fingerprint (long, of all paths and types), layout (string) and turns (array of role and text).

    The hash of the telling paths selects the layout. Where it is no layout's, lists and objects that stand where a text is named count
    as their JSON, and the hash of what remains selects. Null layout, null turns: null records, what isn't a JSON object, a text under
    a name that no layout reads beside the others, a message with two texts or roles. Numbers, flags, nulls and METADATA don't matter.
    Null texts and roles are empty. An empty list gives no turns. Repeated records are records of their own. Input columns of the
    new names are replaced; other columns stay. Empty input: no rows.
    """
    keep = [c for c in records.columns if c not in ("fingerprint", "layout", "turns")]
    record = F.col(column)
    leaves = _any_of([x for y in layouts for x in y.leaves])
    df = records.select(*keep, field_paths(record).alias("__paths")).withColumn("__exact", telling_paths(F.col("__paths"), layouts))
    cut = F.array_sort(F.array_distinct(F.transform("__exact", lambda p: F.regexp_replace(p, rf"^({leaves})[.\[].*$", "$1"))))
    df = df.select(*keep, fingerprint(F.col("__paths")).alias("fingerprint"), fingerprint(F.array_sort("__exact")).alias("__exact"), fingerprint(cut).alias("__cut"))
    quoted = {x.name: ", ".join("xxhash64('" + p.replace("\n", "\\n") + "')" for p in sorted(x.prints)) for x in layouts}
    fits = [f"when {by} in ({quoted[x.name]}) then '{x.name}'" for by in ("__exact", "__cut") for x in reversed(layouts)]  # as text: one expression, not hundreds of calls
    fit = F.expr(f"case {' '.join(fits)} end")
    df = df.select(*keep, "fingerprint", fit.alias("layout"))
    turns = F.lit(None).cast(TURNS)
    for x in layouts:
        turns = F.when(F.col("layout") == x.name, _canonical(x.turns(record))).otherwise(turns)
    return df.withColumn("turns", turns).withColumn("layout", F.when(F.col("turns").isNotNull(), F.col("layout"))).select(*keep, "fingerprint", "layout", "turns")


def _canonical(raw: Column) -> Column:
    def one(m: Column) -> Column:
        role = F.coalesce(m["role"], F.lit(""))
        for other, known in ROLES.items():
            role = F.when(m["role"] == other, F.lit(known)).otherwise(role)
        return F.struct(role.alias("role"), F.coalesce(m["text"], F.lit("")).alias("text"))

    return F.transform(raw, one)


def escape(c: Column) -> Column:
    for plain, entity in ENTITIES:
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def unescape(c: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """df plus formatted (string) and loss_spans (array of start and end, code points) over assistant texts.

    Null turns give null; no turns give an empty string and no spans. Input columns of those names are replaced.
    """
    marked = F.transform(F.col(turns), lambda m: F.struct((m["role"] == "assistant").alias("loss"), F.concat(F.lit("<s>["), escape(m["role"]), F.lit("]")).alias("head"), escape(m["text"]).alias("body")))
    keep = [c for c in df.columns if c not in ("formatted", "loss_spans")]
    df = df.select(*keep, marked.alias("__m"))
    formatted = F.array_join(F.transform("__m", lambda m: F.concat(m["head"], m["body"], F.lit("</s>"))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        a = acc["at"] + F.char_length(m["head"])
        b = a + F.char_length(m["body"])
        span = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + 4).alias("at"), F.when(m["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("__m", start, step, lambda acc: acc["spans"])
    return df.withColumns({"formatted": formatted, "loss_spans": F.when(F.col("__m").isNotNull(), spans)}).drop("__m")


def read_turns(formatted: Column) -> Column:
    """Turns read back from a formatted string."""
    found = F.regexp_extract_all(formatted, F.lit(r"(?s)(<s>\[[^\]]*\][^<]*)</s>"), F.lit(1))
    return F.transform(found, lambda x: F.struct(unescape(F.regexp_extract(x, r"^<s>\[([^\]]*)\]", 1)).alias("role"), unescape(F.regexp_extract(x, r"(?s)^<s>\[[^\]]*\](.*)$", 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): the rows of a conversation in order of turn, role and text (nulls first), as a JSON record.

    Null texts and roles are empty; rows with a null conv_id are one conversation; repeated rows are turns of their own. A hash of the
    id deals conversations to layouts: half to lists of messages of five kinds, half to single fields, where the roles are those of
    such a layout.
    """
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by = rows.groupBy("conv_id").agg(F.collect_list(row).alias("x"))
    ordered = F.array_sort(F.transform("x", lambda m: F.struct(m["turn"].isNotNull().alias("k"), F.coalesce(m["turn"], F.lit(0)).alias("turn"), m["role"].alias("role"), m["text"].alias("text"))))
    by = by.select(F.col("conv_id").cast("long").alias("conv_id"), F.xxhash64("conv_id").alias("h"), ordered.alias("x"))
    ident, kind, way, n = F.col("conv_id"), F.pmod("h", F.lit(5)), F.pmod(F.shiftright("h", 16), F.lit(10)), F.size("x")
    listed = lambda role, text: F.transform("x", lambda m: F.struct(m["role"].alias(role), m["text"].alias(text)))
    piece = lambda t: F.struct(F.lit("text").alias("type"), t.alias("text"))
    half = lambda t: F.floor(F.char_length(t) / 2).cast("int")
    parts = F.transform("x", lambda m: F.struct(m["role"].alias("role"), F.array(piece(F.left(m["text"], half(m["text"]))), piece(F.substring(m["text"], half(m["text"]) + 1, F.char_length(m["text"])))).alias("content")))
    said = lambda i: F.get("x", F.lit(i))["text"] if isinstance(i, int) else F.get("x", i)["text"]
    roles = F.transform("x", lambda m: m["role"])
    one, led = roles == F.array(F.lit("user"), F.lit("assistant")), roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    pairs = (n > 2) & (n % 2 == 0) & F.forall(F.transform("x", lambda m, i: m["role"] == F.when(i % 2 == 0, "user").otherwise("assistant")), lambda ok: ok)
    before = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(n / 2).cast("int") - 2, F.lit(0))), lambda i: F.array(said(i * 2), said(i * 2 + 1)))
    at = F.instr(said(0), "\n\n")
    task, given = F.when(at > 0, F.left(said(0), at - 1)).otherwise(said(0)), F.when(at > 0, F.substring(said(0), at + 2, F.char_length(said(0)))).otherwise("")
    task, given = F.when(given == "", said(0)).otherwise(task), given
    pack = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    single = way >= 5
    record = F.when(single & pairs, pack(instruction=said(n - 2), output=said(n - 1), history=before, id=ident))
    record = record.when(single & led & (kind < 3), pack(system_prompt=said(0), question=said(1), response=said(2)))
    record = record.when(single & led & (said(0) != ""), pack(system=said(0), prompt=said(1), completion=said(2)))
    record = record.when(single & one & (kind == 0), pack(question=said(0), answer=said(1)))
    record = record.when(single & one & (kind == 1), pack(prompt=said(0), response=said(1), source=F.lit("table")))
    record = record.when(single & one & (kind == 2), pack(prompt=said(0), completion=said(1)))
    record = record.when(single & one & (kind == 3), pack(instruction=said(0), output=said(1)))
    record = record.when(single & one, pack(instruction=task, input=given, output=said(1)))
    record = record.when(kind == 0, pack(messages=listed("role", "content"), id=ident))
    record = record.when(kind == 1, pack(id=ident, conversations=listed("from", "value"), origin=F.lit("table")))
    record = record.when(kind == 2, pack(turns=listed("role", "text")))
    record = record.when(kind == 3, F.to_json(F.struct(F.struct(listed("role", "content").alias("messages")).alias("data"), ident.alias("id"))))
    return by.select("conv_id", record.otherwise(pack(messages=parts)).alias("record"))


PROBE = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe; null texts and roles are empty, null ids one conversation, repeated rows turns of their own, no rows: the probe alone."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.to_json(F.struct(F.lit(PROBE).alias("instruction"), F.lit(PROBE).alias("output"))).alias("record"))
    df = format_turns(canonical_turns(conversation_records(rows).unionByName(probe))).select("conv_id", "formatted", "loss_spans")
    df = df.withColumns({"__t": read_turns(F.col("formatted")), "__l": loss_text(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("__t", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    return df.select("conv_id", F.size("__t").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.char_length("__l").cast("long").alias("loss_chars"), F.sha2(F.col("__l").cast("binary"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


_LEN = "length(replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&#91;'), ']', '&#93;'))"
ORACLE = f"""
with r as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
           union all select -1, 0, 'user', '{PROBE}' union all select -1, 1, 'assistant', '{PROBE}'),
n as (select conv_id, turn, text, case role when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant' when 'model' then 'assistant' when 'prompter' then 'user' else role end as role, role as raw from r)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, raw, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, raw, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(9 + {_LEN.format('role')} + {_LEN.format('text')})::bigint as formatted_chars
from n group by conv_id
"""
