"""Chat formatting by grammar round trip.

A conversation is rendered as a sequence of turns,

    conversation := turn*
    turn         := START role BODY text END

then parsed back. Where the parse differs from the source, because a role or text
holds a control string of its own, contents are escaped and the conversation is
rendered and parsed again. An escape puts one `!` after the first character of a
control string, also where some `!` stand there already (`</s>` -> `<!/s>`,
`<!/s>` -> `<!!/s>`), and reading takes one away, so one escaping round makes any
content identical; `round_trip` raises an error otherwise.

DataFrame functions only. One row per conversation: its turns have to fit in a row,
as the formatted conversation does.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of common chat templates.
CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>",
)
TURN_TYPE = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class ChatTemplate:
    """Markers of the grammar, and further strings that no content may show unescaped."""

    start: str = "<|im_start|>"
    body: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    controls: Sequence[str] = field(default=CONTROLS)
    escape: str = "!"
    loss_role: str = "assistant"

    def __post_init__(self) -> None:
        for control in self.all_controls:
            if len(control) < 2 or self.escape in control:
                raise ValueError(f"a control string has two characters and no {self.escape}: {control!r}")

    @property
    def all_controls(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.start, self.body, self.end, *self.controls)))

    def _by_first(self) -> dict[str, str]:
        """First character -> pattern of what may follow it in a control string."""
        rests: dict[str, list[str]] = {}
        for control in self.all_controls:
            rests.setdefault(control[0], []).append(re.escape(control[1:]))
        return {first: "|".join(found) for first, found in rests.items()}

    def escaped(self, content: Column) -> Column:
        for first, rests in self._by_first().items():
            pattern = f"({re.escape(first)})({self.escape}*)(?={rests})"
            content = F.regexp_replace(content, F.lit(pattern), F.lit(f"$1{self.escape}$2"))
        return content

    def unescaped(self, content: Column) -> Column:
        for first, rests in self._by_first().items():
            pattern = f"({re.escape(first)}){self.escape}({self.escape}*)(?={rests})"
            content = F.regexp_replace(content, F.lit(pattern), F.lit("$1$2"))
        return content

    def rendered(self, turns: Column) -> Column:
        return F.array_join(
            F.transform(
                turns,
                lambda t: F.concat(
                    F.lit(self.start), t["role"], F.lit(self.body), t["text"], F.lit(self.end)
                ),
            ),
            "",
        )

    def pieces(self, formatted: Column) -> Column:
        """The escaped role and text of each turn; NULLs where the grammar does not hold."""
        cut = F.split(formatted, F.lit(re.escape(self.end)), -1)
        return F.transform(
            F.slice(cut, F.lit(1), F.greatest(F.size(cut) - 1, F.lit(0))),
            lambda turn: self._piece(F.split(turn, F.lit(re.escape(self.body)), -1)),
        )

    def _piece(self, parts: Column) -> Column:
        holds = (F.size(parts) == 2) & parts[0].startswith(self.start)
        return F.struct(
            F.when(holds, F.substr(parts[0], F.lit(len(self.start) + 1))).alias("role"),
            F.when(holds, parts[1]).alias("text"),
        )

    def parsed(self, formatted: Column) -> Column:
        """The turns of a formatted conversation."""
        return F.transform(
            self.pieces(formatted),
            lambda p: F.struct(
                self.unescaped(p["role"]).alias("role"), self.unescaped(p["text"]).alias("text")
            ),
        ).cast(TURN_TYPE)

    def loss_spans(self, formatted: Column) -> Column:
        """(first character from 0, length) of each text of `loss_role` in the formatted string."""
        empty = F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<first:bigint,length:bigint>>").alias("spans"),
        )

        def step(state: Column, p: Column) -> Column:
            first = state["at"] + len(self.start + self.body) + F.length(p["role"])
            length = F.length(p["text"]).cast("long")
            span = F.struct(first.alias("first"), length.alias("length"))
            under_loss = self.unescaped(p["role"]) == self.loss_role
            return F.struct(
                (first + length + len(self.end)).alias("at"),
                F.when(under_loss, F.concat(state["spans"], F.array(span)))
                .otherwise(state["spans"]).alias("spans"),
            )

        return F.aggregate(self.pieces(formatted), empty, step)["spans"]

    def loss_text(self, formatted: Column, spans: Column) -> Column:
        """What lies under the spans, unescaped, nothing between."""
        return F.array_join(
            F.transform(
                spans,
                lambda s: self.unescaped(
                    F.substr(formatted, (s["first"] + 1).cast("int"), s["length"].cast("int"))
                ),
            ),
            "",
        )


def conversations_of(df: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text).

    Turns go by `turn` (NULL first), ties by role and text; equal rows all stay. NULL roles and
    texts are empty. Rows with a NULL conv_id form one conversation. Other columns are ignored.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = F.array_sort(F.collect_list(turn))
    return df.groupBy("conv_id").agg(
        F.transform(
            ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns")
    )


def round_trip(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Add `formatted`, `escaped` (boolean) and `loss_spans` to (conv_id, turns)."""
    template = template or ChatTemplate()
    same = lambda formatted: template.parsed(F.col(formatted)).eqNullSafe(F.col("turns"))
    safe = F.transform(
        "turns",
        lambda t: F.struct(
            template.escaped(t["role"]).alias("role"), template.escaped(t["text"]).alias("text")
        ),
    )
    tried = conversations.withColumn("_plain", template.rendered(F.col("turns"))).withColumn(
        "escaped", ~_quiet(template, F.col("turns")) | ~same("_plain")
    )
    again = tried.withColumn(
        "formatted", F.when(F.col("escaped"), template.rendered(safe)).otherwise(F.col("_plain"))
    ).drop("_plain")
    checked = again.withColumn(
        "formatted",
        F.when(~F.col("escaped") | same("formatted"), F.col("formatted")).otherwise(
            F.raise_error(F.concat(F.lit("no round trip for conversation "), F.col("conv_id").cast("string")))
        ),
    )
    return checked.withColumn("loss_spans", template.loss_spans(F.col("formatted")))


def _quiet(template: ChatTemplate, turns: Column) -> Column:
    """Whether no content shows a control string: some leave the grammar alone, but mean something to a model."""
    pattern = "|".join(re.escape(c) for c in template.all_controls)
    return ~F.exists(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"]).rlike(pattern))


def format_chats(df: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """(conv_id, turns, escaped, formatted, loss_spans) from rows (conv_id, turn, role, text).

    See `conversations_of` for NULLs, ties and repeated rows. An empty table gives no rows.
    """
    return round_trip(conversations_of(df), template)
