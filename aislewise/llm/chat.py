"""Operator 1: one canonical chat format from records of many layouts, chosen by schema fingerprint.

Records are JSON texts in whatever layout their source uses. A record's fingerprint is the hash of all its nested paths, as
they stand in it: records that differ in any path differ in fingerprint. A layout is selected by the hash of the paths that it
declares and the record holds (such as ``messages[].role``; a member that is null is held); its mapping turns the record into
canonical turns (role, text). Of several layouts that fit, the first declared one is taken, and members that it does not name
are ignored. A record that no layout fits gets no turns and a null ``layout``, and its fingerprint says what it looks like.

Format of a turn: ``### Role: text</turn>`` and a newline. Texts and roles are escaped so that no control string stands
in them: ``\\`` becomes ``\\0``, ``</turn>`` becomes ``\\1``, ``###`` becomes ``\\2`` and, in roles, ``:`` becomes ``\\3``.
After the first step every backslash is followed by a digit, and no replacement can complete another control string,
so the reverse steps give the text back. Each turn carries the span of its text in the formatted string (code points,
end exclusive) and whether it is under the loss mask (assistant turns).

All of it is DataFrame functions, linear in the length of a conversation: offsets are running sums in a window, never
grown arrays. A conversation becomes one value, so it is also the unit of work.

Defined results: null texts and roles count as empty; turns are ordered by turn (nulls first), then role, then text, so
ties and repeated rows have one order and all stay; rows with a null conversation id form one conversation; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>"
MARK = "###"
# The order matters: the backslash first when escaping, last when reading back.
ESCAPES = (("\\", "\\0"), (END, "\\1"), (MARK, "\\2"))
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Either a list of messages, or single fields that are turns of a given role.

    ``fields`` are (role, column) pairs in the order of the turns; ``optional`` columns may be absent. With ``messages``
    the list stands in that column and ``role`` and ``text`` name the fields of its items. ``roles`` renames roles.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = frozenset()
    messages: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def path_sets(self) -> list[list[str]]:
        """Every set of paths that a record of this layout may hold."""
        if self.messages:
            items = [f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"]
            return [[self.messages], [self.messages, items[0]], [self.messages, items[1]], [self.messages, *items]]
        sets = [[]]
        for _, column in self.fields:
            sets = [[*s, column] for s in sets] + ([s for s in sets] if column in self.optional else [])
        return [s for s in sets if s]

    def turns(self) -> Column:
        if self.messages:
            role = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair]) if self.roles else None
            return F.transform(
                F.col(f"record.{self.messages}"),
                lambda m: F.struct(
                    (F.coalesce(role[m[self.role]], m[self.role]) if self.roles else m[self.role]).alias("role"),
                    m[self.text].alias("text"),
                ),
            )
        every = F.array(
            *[F.struct(F.lit(r).alias("role"), F.col(f"record.{c}").alias("text")) for r, c in self.fields]
        )
        return F.filter(every, lambda t: t["text"].isNotNull())


LAYOUTS = (
    Layout("messages", messages="messages", role="role", text="content"),
    Layout(
        "from_value",
        messages="conversations",
        role="from",
        text="value",
        roles={"human": "user", "gpt": "assistant"},
    ),
    Layout("prompt", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout(
        "instruction",
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
        optional=frozenset({"system"}),
    ),
)


def fingerprint_of(paths: list[str]) -> str:
    """The fingerprint that a record holding exactly these paths has."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def record_schema(layouts: tuple[Layout, ...]) -> str:
    """The union of the layouts' fields."""
    columns: dict[str, set[str]] = {}
    for x in layouts:
        if x.messages:
            columns.setdefault(x.messages, set()).update({x.role, x.text})
        for _, c in x.fields:
            columns.setdefault(c, set())
    kinds = (
        f"`{c}`:" + (f"array<struct<{','.join(f'`{i}`:string' for i in sorted(items))}>>" if items else "string")
        for c, items in sorted(columns.items())
    )
    return f"struct<{','.join(kinds)}>"


# Types of single values in the schema of a record; only paths count.
KINDS = r": (STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|VARIANT|DATE|TIMESTAMP|DECIMAL\([0-9]+,[0-9]+\))"


def fingerprint(json: Column) -> Column:
    """Hash of all nested paths of a JSON text; of nothing where it can't be read."""
    paths = F.regexp_replace(F.schema_of_variant(F.try_parse_json(json)), KINDS, "")
    return F.sha2(F.coalesce(paths, F.lit("")), 256)


def selector(layout: Layout) -> Column:
    """Hash of the paths that ``layout`` declares and columns ``record`` and ``keys`` hold."""
    present: dict[str, Column] = {c: F.array_contains("keys", c) for _, c in layout.fields}
    if layout.messages:
        items = F.col(f"record.{layout.messages}")
        present[layout.messages] = items.isNotNull()
        for i in (layout.role, layout.text):
            held = F.exists(items[i], lambda value: value.isNotNull())
            present[f"{layout.messages}[].{i}"] = F.coalesce(held, F.lit(False))
    return F.sha2(F.concat_ws("\n", *[F.when(held, F.lit(path)) for path, held in sorted(present.items())]), 256)


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``record_id``, ``fingerprint``, ``layout`` and ``turns`` of each record (``record_id``, JSON text ``json``)."""
    parsed = records.select(
        "record_id",
        F.from_json("json", record_schema(layouts), {"maxStringLen": str(2**31 - 1)}).alias("record"),
        F.coalesce(F.json_object_keys("json"), F.array().cast("array<string>")).alias("keys"),
        fingerprint(F.col("json")).alias("fingerprint"),
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in reversed(layouts):
        fits = selector(x).isin([fingerprint_of(paths) for paths in x.path_sets()])
        layout = F.when(fits, F.lit(x.name)).otherwise(layout)
        turns = F.when(fits, x.turns().cast(TURNS)).otherwise(turns)
    return parsed.select("record_id", "fingerprint", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def render(records: DataFrame) -> DataFrame:
    """``record_id``, ``formatted`` and ``spans`` (start, end, loss) of canonical records."""
    role = F.coalesce("turn.role", F.lit(""))
    body = escape(F.coalesce("turn.text", F.lit("")))
    head = F.concat(F.lit(f"{MARK} "), F.replace(escape(role), F.lit(":"), F.lit("\\3")), F.lit(": "))
    pieces = records.select("record_id", F.posexplode_outer("turns").alias("at", "turn")).select(
        "record_id", "at", F.when(F.col("at").isNotNull(), head).alias("head"), body.alias("body"), (role == "assistant").alias("loss")
    )
    length = F.length("head") + F.length("body") + len(END) + 1
    so_far = F.sum(length).over(Window.partitionBy("record_id").orderBy("at")).cast("long")
    end = so_far - (len(END) + 1)
    piece = F.struct(
        "at",
        F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.struct((end - F.length("body")).alias("start"), end.alias("end"), "loss").alias("span"),
    )
    gathered = pieces.select("record_id", F.when(F.col("at").isNotNull(), piece).alias("p")).groupBy("record_id")
    return gathered.agg(F.sort_array(F.collect_list("p")).alias("p")).select(
        "record_id",
        F.array_join("p.piece", "").alias("formatted"),
        F.col("p.span").alias("spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``record_id``, ``turns`` and ``loss_texts`` read from ``formatted`` and ``spans`` alone."""
    pieces = F.split("formatted", END + "\n", -1)
    held = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    role = lambda p: unescape(F.replace(F.substring_index(F.substr(p, F.lit(len(MARK) + 2)), ": ", 1), F.lit("\\3"), F.lit(":")))
    text = lambda p: unescape(F.substr(p, F.locate(": ", p) + 2))
    # A span is as long as the text that ends its piece; cutting inside the piece keeps the work linear.
    under = lambda p, s: F.when(s["loss"], unescape(F.right(p, F.greatest(s["end"] - s["start"], F.lit(0)).cast("int"))))
    return formatted.select(
        "record_id",
        F.transform(held, lambda p: F.struct(role(p).alias("role"), text(p).alias("text"))).alias("turns"),
        F.filter(F.zip_with(held, "spans", under), lambda t: t.isNotNull()).alias("loss_texts"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def pack(rows: DataFrame) -> DataFrame:
    """JSON records in several layouts from a table with a row per turn (conv_id, turn, role, text).

    Each conversation takes the layout that its shape allows: a question and its answer, the same after a system turn,
    and otherwise one of the two message lists by a hash of its id. None of them loses a role or a text.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.col("t.role")
    is_ = lambda *names: F.concat_ws(",", roles) == ",".join(names)
    at = lambda i: F.get("t", F.lit(i))["text"]
    plain = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    messages = F.struct(
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")
    )
    alias = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    shared = F.struct(
        F.transform("t", lambda t: F.struct(alias(t["role"]).alias("from"), t["text"].alias("value"))).alias("conversations")
    )
    json = (
        F.when(is_("user", "assistant"), F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when(
            is_("system", "user", "assistant"),
            F.to_json(F.struct(at(0).alias("system"), at(1).alias("instruction"), at(2).alias("output"))),
        )
        .when(plain & (F.pmod(F.xxhash64("conv_id"), F.lit(2)) == 0), F.to_json(shared))
        .otherwise(F.to_json(messages))
    )
    return whole.select(F.col("conv_id").alias("record_id"), json.alias("json"))


def digests(rows: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Counts and digests per conversation, read back from the formatted texts."""
    back = read_back(render(canonical(pack(rows.select("conv_id", "turn", "role", "text")), layouts)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        F.col("record_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
