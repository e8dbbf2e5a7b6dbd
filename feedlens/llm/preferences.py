"""Preference pairs as one prompt and two masked completions (operator 4).

A pair is a chosen and a rejected conversation. The longest common prefix of their turns is
rendered once as the prompt; what follows on either side is a completion with the spans
that bear loss, the contents of the assistant's turns. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(TURN_START), turn["role"], F.lit("\n"), turn["text"], F.lit(TURN_END))


def conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(id, turns): the turns of each conversation in order, as an array of (role, text).

    Null roles and texts count as empty; turns of equal number are ordered by role and text,
    and a repeated turn counts once; null turn numbers come first; rows without an id are no
    conversation and are left out.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"))
    ordered = F.array_sort(F.collect_set(turn))
    return (turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
            .agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                 .alias("turns")))


def common_turns(a: Column, b: Column) -> Column:
    """Number of turns that both arrays start with."""
    differs = F.zip_with(a, b, lambda x, y: ~(x.eqNullSafe(y)))
    first = F.array_position(differs, True)
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def masked(turns: Column) -> tuple[Column, Column]:
    """Text of the turns, and the code point spans in it that bear loss, as start:end joined
    by commas (end exclusive)."""
    text = F.array_join(F.transform(turns, rendered), "")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.char_length(F.lit(TURN_START)) + F.char_length(turn["role"]) + 1
        end = begin + F.char_length(turn["text"])
        span = F.concat(F.when(state["spans"] == "", "").otherwise(","), begin.cast("string"), F.lit(":"),
                        end.cast("string"))
        learned = (turn["role"] == LEARNED_ROLE) & (begin < end)
        return F.struct((end + F.char_length(F.lit(TURN_END))).alias("at"),
                        F.concat(state["spans"], F.when(learned, span).otherwise("")).alias("spans"))

    return text, F.aggregate(turns, start, add, lambda s: s["spans"])


def format_pairs(pairs: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Rows with ``chosen`` and ``rejected`` (arrays of (role, text)) as training texts.

    Returns ``keep``, ``n_prompt_turns``, ``prompt``, and for both sides the completion and
    its loss spans. A null side counts as a conversation without turns; equal conversations
    are all prompt and have empty completions; repeated pairs stay.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    rows = pairs.select(*keep, F.coalesce("chosen", none).alias("chosen"),
                        F.coalesce("rejected", none).alias("rejected"))
    rows = rows.withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    after = F.col("n_prompt_turns") + 1
    out = [*keep, "n_prompt_turns",
           F.array_join(F.transform(F.slice("chosen", F.lit(1), F.col("n_prompt_turns")), rendered), "")
           .alias("prompt")]
    for side in ("chosen", "rejected"):
        text, spans = masked(F.slice(side, after, F.greatest(F.size(side) - after + 1, F.lit(0))))
        out += [text.alias(side), spans.alias(f"{side}_loss")]
    return rows.select(*out)


def last_reply(turns: Column) -> Column:
    """Place (from 1) of the last turn of the learned role; 0 without one."""
    from_end = F.array_position(F.transform(F.reverse(turns), lambda t: t["role"] == LEARNED_ROLE), True)
    return F.when(from_end > 0, F.size(turns) - from_end + 1).otherwise(0).cast("int")


def neighbour_pairs(found: DataFrame) -> DataFrame:
    """(id, chosen, rejected) for each conversation of (id, turns) that has a reply.

    Chosen is the conversation up to its last reply. Rejected has the last reply of the
    conversation whose id differs in the lowest bit instead, a reply to other words; null if
    there is no such conversation or it has no reply.
    """
    cut = found.withColumn("last", last_reply(F.col("turns"))).where("last > 0").select(
        "id", F.slice("turns", F.lit(1), F.col("last")).alias("chosen"),
        F.element_at("turns", F.col("last")).alias("reply"))
    other = cut.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("reply").alias("other"))
    swapped = F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array("other"))
    return cut.join(other, "id", "left").select(
        "id", "chosen", F.when(F.col("other").isNotNull(), swapped).alias("rejected"))


def preferences(turns: DataFrame) -> DataFrame:
    """(conv_id, n_prompt_turns, prompt, chosen, chosen_loss, rejected, rejected_loss) for each
    conversation with a reply; see :func:`neighbour_pairs` and :func:`format_pairs`."""
    pairs = neighbour_pairs(conversations(turns)).withColumnRenamed("id", "conv_id")
    return format_pairs(pairs, ["conv_id"])


#: The same rows in DuckDB's SQL.
PREFERENCES_SQL = """
with turns_ as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from turns_),
last_ as (select conv_id, max(i) as last from placed where role = 'assistant' group by conv_id),
cut as (select p.* , l.last from placed p join last_ l using (conv_id) where p.i <= l.last),
reply as (select xor(conv_id, 1) as conv_id, role, text from cut where i = last),
sides as (
  select conv_id, i, last, 'chosen' as side, role, text from cut
  union all
  select c.conv_id, c.i, c.last, 'rejected', case when c.i = c.last then r.role else c.role end,
         case when c.i = c.last then r.text else c.text end
  from cut c join reply r using (conv_id)),
same as (
  select a.conv_id, a.i, a.role = b.role and a.text = b.text as equal
  from sides a left join sides b on a.conv_id = b.conv_id and a.i = b.i and b.side = 'rejected'
  where a.side = 'chosen'),
prefix as (
  select conv_id, coalesce(min(case when coalesce(equal, false) then null else i end) - 1, max(i))::int as n
  from same group by conv_id),
shown as (
  select s.*, p.n, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as shown
  from sides s join prefix p using (conv_id)),
spans as (
  select *, coalesce(sum(length(shown)) over (partition by conv_id, side order by i
    rows between unbounded preceding and 1 preceding), 0) + 12 + length(role) + 1 as begin_
  from shown where i > n),
parts as (
  select conv_id, side, string_agg(shown, '' order by i) as completion,
    string_agg(begin_::bigint || ':' || (begin_ + length(text))::bigint, ',' order by i)
      filter (where role = 'assistant' and length(text) > 0) as loss
  from spans group by conv_id, side),
prompts as (
  select conv_id, string_agg(shown, '' order by i) as prompt from shown
  where side = 'chosen' and i <= n group by conv_id)
select p.conv_id, p.n as n_prompt_turns, coalesce(m.prompt, '') as prompt,
  coalesce(c.completion, '') as chosen, coalesce(c.loss, '') as chosen_loss,
  coalesce(r.completion, '') as rejected, coalesce(r.loss, '') as rejected_loss
from prefix p left join prompts m using (conv_id)
left join parts c on c.conv_id = p.conv_id and c.side = 'chosen'
left join parts r on r.conv_id = p.conv_id and r.side = 'rejected'
"""
