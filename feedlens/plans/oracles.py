"""SQL checks (DuckDB dialect) for the registered queries, on the same Parquet tables."""

from __future__ import annotations

from functools import reduce

from feedlens import rules
from feedlens.functions.numbers import NUMBER
from feedlens.functions.text import NOT_WS, WS
from feedlens.plans.queries import CHANNELS, MEDIA_FOLDER
from feedlens.sources.shop_tables import SEED_TEXTS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(expr: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({expr}, {quoted(w)})" for w in words) + ")"


def replaced(expr: str, pairs) -> str:
    return reduce(lambda e, p: f"replace({e}, {quoted(p[0])}, {quoted(p[1])})", pairs, expr)


def translated(expr: str, mapping: dict[str, str]) -> str:
    return f"translate({expr}, {quoted(''.join(mapping))}, {quoted(''.join(mapping.values()))})"


def rounded(expr: str, digits: int = 2) -> str:
    return f"cast(round(cast({expr} as decimal(30,10)), {digits}) as double)"


def joined(items: str) -> str:
    return f"coalesce(array_to_string({items}, ' '), '')"


NL = "chr(10)"
SEEDS = " ".join(f"when {i} then {quoted(t)}" for i, t in enumerate(SEED_TEXTS))

POSTS = f"""posts as (
  select doc_id as id, source as channel_title,
         case when doc_id % 2 = 0 then '@' || source else '@shop_' || source end as channel_username,
         (case doc_id % {len(SEED_TEXTS)} {SEEDS} end) || {NL} || text as text,
         case when doc_id % 17 = 0 then '' when doc_id % 23 = 0 then null else text end as message,
         n_chars as views, doc_id % 4 = 0 as has_photo
  from documents)"""

MESSAGES = POSTS + """, messages as (
  select p.*, e.ts as ts0,
         case when p.id % 29 = 0 then 'bad' else cast(e.ts as varchar) end as date,
         case when p.id % 5 < 3 then t.p_name end as ent_word,
         case when p.id % 5 < 3 then t.p_retailprice end as ent_price
  from posts p join events e on e.event_id = p.id left join part t on t.p_partkey = p.id)"""

SCORED = MESSAGES + """, scored as (
  select *, channel_title as vendor, cast(date as timestamp) as ts
  from messages where date <> 'bad')"""

STRIPPED = "trim(channel_username, '@')"
MEDIA = (
    f"case when has_photo then '{MEDIA_FOLDER}/' || {STRIPPED} || '_' || cast(id as varchar) || '.jpg' end"
)


def normalized(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


def words(expr: str) -> str:
    return f"regexp_extract_all({expr}, '{NOT_WS}+')"


FIRST = f"split_part(text, {NL}, 1)"
REST = f"case when contains(text, {NL}) then substr(text, instr(text, {NL}) + 1) else '' end"
PHONE = r"regexp_full_match(token, '\d{10}')"
PRICE = rf"(regexp_full_match(token, '\d+(\.\d{{1,2}})?') or {any_of('token', rules.PRICE_MARKS)})"
PLACE = any_of("token", rules.LOCATIONS)
REST_LABEL = (
    f"case when {PHONE} then 'I-PHONE' when {PRICE} then 'I-PRICE' when {PLACE} then 'I-LOC' else 'O' end"
)

# sid, pos, token, previous, label, test
TOKENS = POSTS + f""", parts as (
  select id as sid, {words(FIRST)} as f, {words(REST)} as r from posts),
flat as (
  select sid, unnest(list_concat(f, r)) as token,
         unnest(range(len(f) + len(r))) as pos, len(f) as nfirst from parts),
tokens as materialized (
  select sid, cast(pos as integer) as pos, token,
         lag(token, 1, '') over (partition by sid order by pos) as previous,
         case when pos < nfirst then case when pos = 0 then 'B-PRODUCT' else 'I-PRODUCT' end
              else {REST_LABEL} end as label,
         cast('0x' || substr(md5(cast(sid as varchar)), 1, 4) as integer) % 5 = 0 as test
  from flat)"""

LABELS = "labels(label, lid) as (values " + ", ".join(
    f"('{t}', {i})" for i, t in enumerate(rules.TAGS)
) + ")"


def spans_of(source: str, tag: str, out: str) -> str:
    """Typed islands of a tag column: sid, type, start, end and a span number per token."""
    return f"""{out}_a as (
  select *, case when {tag} like 'B-%' or {tag} like 'I-%' then substr({tag}, 3) end as type,
         lag({tag}) over (partition by sid order by pos) as before from {source}),
{out}_b as (
  select *, case when {tag} like 'B-%' or ({tag} like 'I-%' and type is distinct from
              case when before like 'B-%' or before like 'I-%' then substr(before, 3) end)
            then 1 else 0 end as opened from {out}_a),
{out}_c as (
  select *, sum(opened) over (partition by sid order by pos) as span from {out}_b),
{out} as (
  select sid, type, min(pos) as "start", max(pos) as "end" from {out}_c
  where type is not null group by sid, span, type)"""


FEATURE_KEYS = {
    "token": "token",
    "suffix": "right(token, 3)",
    "prev_token": "previous || chr(9) || token",
    "prior": "''",
}


TAG_LIST = "[" + ", ".join(quoted(t) for t in rules.TAGS) + "]"


def model(features: list[str], name: str = "model") -> str:
    """Smoothed P(label | key) of each feature as lists in label order, from the training part."""
    keyed = " union all ".join(
        f"select '{f}' as feature, {FEATURE_KEYS[f]} as key, label from tokens where not test"
        for f in [*features, "prior"]
    )
    counts = ", ".join(f"count(*) filter (where label = {quoted(t)})" for t in rules.TAGS)
    return f"""{name}_n as materialized (
  select feature, key, count(*) as total, [{counts}] as counts from ({keyed}) group by feature, key),
{name} as materialized (
  select *, list_transform(counts, lambda n: (n + 1) / (total + {len(rules.TAGS)})) as scores from {name}_n)"""


def tagging(features: list[str], name: str = "model", out: str = "tagged") -> str:
    """Test tokens with prediction, score and the probability of the true label."""
    joins = " ".join(
        f"left join (select key, scores from {name} where feature = '{f}') k{i} on k{i}.key = {FEATURE_KEYS[f]}"
        for i, f in enumerate(features)
    )
    found = ", ".join(f"k{i}.scores" for i in range(len(features)))
    return f"""{out}_s as (
  select x.*, coalesce({found}, (select scores from {name} where feature = 'prior')) as scores
  from (select * from tokens where test) x {joins}),
{out} as materialized (
  select * exclude (scores), {TAG_LIST}[list_position(scores, list_max(scores))] as prediction,
         list_max(scores) as score, scores[list_position({TAG_LIST}, label)] as p_true from {out}_s)"""


SUFFIXED = ["token", "suffix"]
TAGGED = f"{TOKENS}, {model(SUFFIXED)}, {tagging(SUFFIXED)}"
TAGGED_SPANS = f"{TAGGED}, {spans_of('tagged', 'label', 'truth')}, {spans_of('tagged', 'prediction', 'guess')}"
HITS = """hits as (
  select * from truth join guess using (sid, type, "start", "end"))"""

# Offsets in the message: each token with the whitespace before it. Gaps and tokens in turn are
# the text, so gap i stands before token i if the text begins with whitespace, else token i - 1.
GROUPED = f"""{TAGGED}, gaps as (
  select sid, cast(unnest(range(len(g))) as integer) as pos, unnest(g) as gap from (
    select id as sid, case when regexp_matches(text, '^{WS}') then regexp_extract_all(text, '{WS}+')
           else list_prepend('', regexp_extract_all(text, '{WS}+')) end as g
    from posts)),
placed as (
  select *, sum(len(gap) + len(token)) over (partition by sid order by pos) as last_char
  from tagged join gaps using (sid, pos)),
{spans_of('placed', 'prediction', 'guess')},
slices as (
  select sid, span, type, avg(score) as mean, cast(min(last_char - len(token)) as bigint) as "start",
         cast(max(last_char) as bigint) as "end" from guess_c group by sid, span, type),
entities as (
  select sid, span, type as entity, substr(text, "start" + 1, "end" - "start") as word, mean, "start", "end"
  from slices join posts on id = sid where type is not null),
texts as (
  select distinct sid, text from tagged join posts on id = sid)"""


def scores(found: str, predicted: str, actual: str) -> str:
    def ratio(a, b):
        return rounded(f"case when {b} > 0 then {a} / {b} else 0.0 end", 6)

    return (
        f"{ratio(found, predicted)} as precision, {ratio(found, actual)} as recall, "
        f"{ratio(f'2 * {found}', f'({predicted} + {actual})')} as f1"
    )


def evaluation(variant: str, features: list[str], n: int) -> str:
    m, t = f"m{n}", f"t{n}"
    return f"""{model(features, m)}, {tagging(features, m, t)},
{spans_of(t, 'label', f'a{n}')}, {spans_of(t, 'prediction', f'p{n}')},
result{n} as (
  select '{variant}' as model,
         (select {rounded('avg(-ln(p_true))', 6)} from {t}) as eval_loss,
         {rounded(f'''2 * (select count(*) from a{n} join p{n} using (sid, type, "start", "end"))
           / ((select count(*) from a{n}) + (select count(*) from p{n}))''', 6)} as eval_f1)"""


COMPARED = ", ".join([
    TOKENS,
    evaluation("token", ["token"], 0),
    evaluation("token+suffix", ["token", "suffix"], 1),
    evaluation("prev+token", ["prev_token", "token"], 2),
])

# Piece arrays: parallel lists of piece text and word index.
PIECES = f"""{TOKENS}, {LABELS}, words as (
  select t.sid, t.pos, t.token, l.lid from tokens t join labels l using (label)),
chunks as (
  select sid, pos, lid, unnest(range(cast(greatest(ceil(len(token) / 4.0), 1) as integer))) as j, token
  from words),
pieces as (
  select sid, pos, j, lid, substr(token, cast(j * 4 + 1 as bigint), 4) as piece from chunks),
ids as (select id as sid from posts)"""
ALIGNED = f"""{PIECES}, aligned as (
  select sid, list(case when j = 0 then lid else -100 end order by pos, j) as body
  from pieces group by sid),
framed as (
  select sid, list_concat([-100], coalesce(body, []), [-100]) as label_ids from ids left join aligned using (sid))"""
ALIGNED_SELECT = f"with {ALIGNED} select sid, {joined('label_ids')} as label_ids from framed"

EMOJI = "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in rules.EMOJI_RANGES) + "]+"
SHORT_MAP = "map {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in rules.SHORT_FORMS.items()) + "}"


def no_emoji(e: str) -> str:
    return f"regexp_replace({e}, '{EMOJI}', '', 'g')"


def plain_labials(e: str) -> str:
    return translated(replaced(e, rules.labialized_pairs()), rules.LABIAL_U_LETTERS)


def long_forms(e: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({e}, '{NOT_WS}+|{WS}+'), "
        f"lambda w: coalesce({SHORT_MAP}[w], w)), '')"
    )


def plain_punct(e: str) -> str:
    return translated(replaced(e, rules.PUNCT_SEQUENCES), rules.PUNCT_LETTERS)


def plain_chars(e: str) -> str:
    return translated(e, rules.homophone_map())


def script_words(e: str, script: str) -> str:
    return joined(f"regexp_extract_all({e}, '[{rules.SCRIPTS[script]}]+')")


def per_post(expr: str) -> str:
    return f"with {POSTS} select id, {expr} as text from posts"


REST_TOKENS = f"""with {POSTS}, lists as (select id, {words(REST)} as r from posts),
rest as (select id, cast(unnest(range(len(r))) as integer) as pos, unnest(r) as token from lists)"""

RECORD = f"""select channel_title, channel_username, id, {normalized("coalesce(message, '')")} as message,
       date, {MEDIA} as media_path from messages"""
CLEAN = f"""select id, channel_username, {normalized('message')} as message from posts
where len({normalized('message')}) > 0"""
CHANNEL_LIST = ", ".join(quoted(c) for c in CHANNELS)
WEEKS = "greatest(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) / 7.0, 1.0)"
PER_WEEK = rounded(f"count(*) / {WEEKS}")
AVG_VIEWS = rounded("avg(views)")
TOP = "row_number() over (partition by vendor order by views desc, id) = 1"
BARE = f"regexp_replace(replace(replace(token, ',', ''), 'ETB', ''), '^{WS}+|{WS}+$', '', 'g')"
IMAGES = f"""with {POSTS}, images as (
  select regexp_extract({STRIPPED} || '_' || cast(id as varchar) || '.jpg', '[^/]+$') as image from posts)"""


def streamed(name: str) -> str:
    return f"""with {MESSAGES} select channel_title, {name} as channel_username, id,
      {normalized("coalesce(message, '')")} as message, cast(ts0 as varchar) as date, {MEDIA} as media_path
      from messages"""


ORACLES: dict[str, str] = {
    # A
    "read_messages": f"""with {MESSAGES} select channel_title, channel_username, id,
        nullif(message, '') as message, date, {MEDIA} as media_path from messages""",
    "write_messages_roundtrip": f"with {MESSAGES} select * from ({RECORD}) where len(message) > 0",
    "latest_n_per_channel": f"""with {POSTS} select channel_username, id, views from posts
        qualify row_number() over (partition by channel_username order by id desc) <= 5""",
    "latest_messages": f"""with {POSTS}, landed as (
          select channel_username, id, message from posts
          union all select channel_username, id, message from posts where id % 3 = 0)
        select channel_username, id, message from landed
        qualify row_number() over (partition by channel_username order by id desc) <= 5""",
    "message_record": f"with {MESSAGES} {RECORD}",
    "media_path": f"with {POSTS} select id, {MEDIA} as media_path from posts",
    "conll_lines": f"""with {TOKENS}, blocks as (
        select sid, string_agg(token || chr(9) || label, {NL} order by pos) as block from tokens group by sid)
        select p.id as sid, coalesce(block, '') as block from posts p left join blocks b on b.sid = p.id""",
    "read_conll": f"""with {TOKENS}, blocks as (
        select sid, string_agg(token || chr(9) || label, {NL} order by pos) as block from tokens group by sid)
        select md5(block) as digest, count(*) as sentences, max(len(block)) as chars from blocks group by 1""",
    "image_files": f"""with {POSTS} select regexp_extract({MEDIA}, '[^/]+$') as image from posts
        where has_photo""",
    # B
    "normalize_ws": per_post(normalized("text")),
    "clean_messages": f"with {POSTS} {CLEAN}",
    "text_or_empty": f"with {POSTS} select id, coalesce(message, '') as message from posts",
    "drop_null_text": f"with {POSTS} select id, message from posts where message is not null",
    "first_n_messages": f"""with {POSTS} select id, message from posts where message is not null
        order by id limit {rules.LABELLED_MESSAGES}""",
    "parse_timestamp": f"""with {MESSAGES} select id, epoch_us(try_cast(date as timestamp)) as timestamp_us
        from messages where try_cast(date as timestamp) is not null""",
    "vendor_column": f"with {POSTS} select id, channel_title as vendor from posts",
    "default_views": f"""with {POSTS} select id,
        cast('0x' || substr(md5(cast(id as varchar)), 1, 6) as bigint) % 4951 + 50 as views from posts""",
    "default_entities": f"""with {TOKENS}, {spans_of('tokens', 'label', 'spans')},
        amounts as (
          select sid, arg_min(token, pos) as price from tokens
          where label = 'I-PRICE' and regexp_matches(token, '{NUMBER}') group by sid),
        items as (
          select sid, span, type, min(pos) as first_pos, arg_min(label, pos) as label,
                 string_agg(token, ' ' order by pos) as word
          from spans_c where type is not null group by sid, span, type)
        select i.sid as id, cast(row_number() over (partition by i.sid order by first_pos) - 1 as integer) as pos,
               label, word, case when type = 'PRODUCT' then price end as price
        from items i left join amounts a on a.sid = i.sid""",
    "channel_filter": f"""with {POSTS} select id, channel_username from posts
        where channel_username in ({CHANNEL_LIST})""",
    "preview": f"""with {POSTS} select channel_username, message from posts
        order by id limit {rules.PREVIEW_ROWS}""",
    # C
    "remove_emoji": per_post(no_emoji("text")),
    "norm_labialized": per_post(plain_labials("text")),
    "norm_short_forms": per_post(long_forms("text")),
    "norm_punct": per_post(plain_punct("text")),
    "norm_chars": per_post(plain_chars("text")),
    "word_tokenize": per_post(script_words("text", "letters")),
    "preprocess_message": per_post(
        script_words(plain_chars(plain_punct(long_forms(plain_labials(no_emoji("text"))))), "ethiopic")
    ),
    "ws_tokens": per_post(joined(words("text"))),
    "first_line": f"with {POSTS} select id, {FIRST} as first, {REST} as rest from posts",
    "text_lines": f"""with {POSTS}, lists as (select id, string_split({REST}, {NL}) as l from posts)
        select id, cast(unnest(range(len(l))) as integer) as line, unnest(l) as body from lists""",
    "clean_price": f"""with {POSTS}, lists as (select id, {words('text')} as l from posts),
        toks as (select id, cast(unnest(range(len(l))) as integer) as pos, unnest(l) as token from lists),
        bare as (select id, pos, {BARE} as b from toks)
        select id, pos, cast(b as double) as price from bare where regexp_matches(b, '{NUMBER}')""",
    # D
    "label_first_line": f"""with {POSTS}, lists as (select id, {words(FIRST)} as l from posts),
        toks as (select id, cast(unnest(range(len(l))) as integer) as pos, unnest(l) as token from lists)
        select id, pos, token, case when pos = 0 then 'B-PRODUCT' else 'I-PRODUCT' end as label from toks""",
    "label_phone": f"{REST_TOKENS} select id, pos, token from rest where {PHONE}",
    "label_price": f"{REST_TOKENS} select id, pos, token from rest where {PRICE}",
    "label_location": f"{REST_TOKENS} select id, pos, token from rest where {PLACE}",
    "label_location_table": f"""{REST_TOKENS}, gazetteer as (
          select unnest([{', '.join(map(quoted, rules.LOCATIONS))}]) as place
          union select lower(n_name) from nation union select lower(split_part(p_name, ' ', 1)) from part),
        places as (
          select token from (select distinct token from rest) t
          where exists (select 1 from gazetteer where contains(token, place)))
        select id, pos, token from rest semi join places using (token)""",
    "label_rest_tokens": f"""{REST_TOKENS} select id, {REST_LABEL} as label, count(*) as tokens
        from rest group by 1, 2""",
    "label_message": f"""with {TOKENS}, sents as (
          select sid, string_agg(token, ' ' order by pos) as words,
                 string_agg(label, ' ' order by pos) as labels from tokens group by sid)
        select p.id as sid, coalesce(words, '') as words, coalesce(labels, '') as labels
        from posts p left join sents s on s.sid = p.id""",
    "label_counts": f"with {TOKENS} select label, count(*) as tokens from tokens group by label",
    "run_labelling": f"""with {POSTS}, lists as (
          select regexp_extract_all({plain_chars(plain_punct(long_forms(plain_labials(no_emoji('text')))))},
                                    '[{rules.SCRIPTS['ethiopic']}]+') as l from posts)
        select case when pos = 0 then 'B-PRODUCT' else 'I-PRODUCT' end as label, count(*) as tokens
        from (select unnest(range(len(l))) as pos from lists) group by 1""",
    "labeled_message_count": "select count(*) as messages from documents",
    # E
    "label_list": f"with {TOKENS} select distinct label from tokens",
    "label_index": f"""with {TOKENS}, l as (select distinct label from tokens)
        select label, cast(row_number() over (order by label) - 1 as integer) as label_id from l""",
    "encode_tags": f"""with {TOKENS}, {LABELS}, sents as (
          select sid, string_agg(cast(lid as varchar), ' ' order by pos) as ids,
                 string_agg(label, ' ' order by pos) as tags
          from tokens join labels using (label) group by sid)
        select p.id as sid, coalesce(ids, '') as ids, coalesce(tags, '') as tags
        from posts p left join sents s on s.sid = p.id""",
    "train_test_split": """select doc_id as id, case
        when cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 4) as integer) % 5 = 0
        then 'test' else 'train' end as part from documents""",
    "train_test_split_exact": """select doc_id as id,
        row_number() over (order by md5(cast(doc_id as varchar))) <= ceil(0.2 * count(*) over ()) as test
        from documents""",
    "word_pieces": f"""with {PIECES}, sents as (
          select sid, string_agg(piece || '@' || cast(pos as varchar), ' ' order by pos, j) as pieces
          from pieces group by sid)
        select sid, coalesce(pieces, '') as pieces from ids left join sents using (sid)""",
    "align_labels": ALIGNED_SELECT,
    "truncate_pad": f"""with {ALIGNED}, cut as (
          select sid, case when len(label_ids) > {rules.MAX_PIECES}
            then list_concat(label_ids[1:{rules.MAX_PIECES - 1}], [-100]) else label_ids end as l from framed)
        select sid, cast(len(l) as integer) as pieces,
          {joined(f"list_concat(l, list_transform(range({rules.MAX_PIECES} - len(l)), lambda x: -100))")} as label_ids
        from cut""",
    # F
    "train_tagger": f"""with {TOKENS}, {model(SUFFIXED)}
        select feature, key, total, unnest({TAG_LIST}) as label, unnest(counts) as n, unnest(scores) as score
        from model""",
    "argmax_labels": f"""with {TOKENS}, {model(['token'])}
        select feature, key, {TAG_LIST}[list_position(scores, list_max(scores))] as label from model""",
    "mask_pairs": f"""with {TOKENS}, {LABELS}, rows as (
          select sid, string_agg(case when pos = 0 then '0:' else '4:' end || cast(lid as varchar), ' ' order by pos) as pairs
          from tokens join labels using (label) group by sid)
        select p.id as sid, coalesce(pairs, '') as pairs from posts p left join rows r on r.sid = p.id""",
    "entity_spans": f"""with {TOKENS}, {spans_of('tokens', 'label', 'spans')}
        select sid, type, "start", "end" from spans""",
    "entity_f1": f"""with {TAGGED_SPANS}, {HITS}, counts as (
          select (select count(*) from hits) as found, (select count(*) from guess) as predicted,
                 (select count(*) from truth) as actual)
        select {scores('found', 'predicted', 'actual')}, found, predicted, actual from counts""",
    "classification_report": f"""with {TAGGED_SPANS}, {HITS}, per as (
          select type as name, count(*) filter (where k = 'h') as found,
                 count(*) filter (where k = 'p') as predicted, count(*) filter (where k = 't') as support
          from (select type, 'h' as k from hits union all select type, 'p' from guess
                union all select type, 't' from truth) group by type),
        ratios as (
          select *, case when predicted > 0 then found / predicted else 0.0 end as p,
                 case when support > 0 then found / support else 0.0 end as r,
                 case when predicted + support > 0 then 2 * found / (predicted + support) else 0.0 end as f from per)
        select name, {rounded('p', 6)} as precision, {rounded('r', 6)} as recall, {rounded('f', 6)} as f1,
               support from ratios
        union all
        select 'micro avg', {rounded('sum(found) / sum(predicted)', 6)}, {rounded('sum(found) / sum(support)', 6)},
               {rounded('2 * sum(found) / (sum(predicted) + sum(support))', 6)}, cast(sum(support) as bigint) from per
        union all
        select 'macro avg', {rounded('avg(p)', 6)}, {rounded('avg(r)', 6)}, {rounded('avg(f)', 6)},
               cast(sum(support) as bigint) from ratios
        union all
        select 'weighted avg', {rounded('sum(p * support) / sum(support)', 6)},
               {rounded('sum(r * support) / sum(support)', 6)}, {rounded('sum(f * support) / sum(support)', 6)},
               cast(sum(support) as bigint) from ratios""",
    "apply_tagger": f"""with {TAGGED} select sid, pos, token, prediction, {rounded('score', 6)} as score
        from tagged""",
    "eval_loss": f"with {TAGGED} select {rounded('avg(-ln(p_true))', 6)} as eval_loss from tagged",
    "model_comparison": f"""with {COMPARED} select * from result0 union all select * from result1
        union all select * from result2""",
    # G
    "group_entities": f"""with {GROUPED} select sid, entity, word, {rounded('mean', 6)} as score, "start", "end"
        from entities""",
    "entity_report": f"""with {GROUPED} select text, word, entity as label, {rounded('mean', 6)} as score
        from entities join texts using (sid)""",
    "low_confidence": f"""with {GROUPED}, best as (
          select sid, count(*) as n, max(mean) as best from entities group by sid)
        select sid, cast(coalesce(n, 0) as integer) as entities, coalesce(best, 0) < {rules.LOW_CONFIDENCE} as flagged
        from texts left join best using (sid)""",
    "highlight_entities": f"""with {GROUPED}, marks as (
          select sid, "start" as place, 1 as kind, case when entity = 'PRODUCT'
            then {quoted(rules.SPAN_OPEN.format(color=rules.PRODUCT_COLOR))}
            else {quoted(rules.SPAN_OPEN.format(color=rules.OTHER_COLOR))} end as mark from entities
          union all select sid, "end", 0, '{rules.SPAN_CLOSE}' from entities
          union all select sid, 0, -1, '' from texts),
        pieces as (
          select sid, place, kind, mark || substr(text, place + 1,
            coalesce(lead(place) over (partition by sid order by place, kind), length(text)) - place) as piece
          from marks join texts using (sid))
        select sid, string_agg(piece, '' order by place, kind) as html from pieces group by sid""",
    "text_report": f"""with {GROUPED} select text, word, entity as label, {rounded('mean', 6)} as score
        from entities join texts using (sid)""",
    "label_names": f"""with {TOKENS}, named as (
          select case label when 'O' then 'LABEL_0' when 'B-PRODUCT' then 'LABEL_1'
                 when 'I-PRODUCT' then 'LABEL_2' end as name from tokens)
        select name, case name when 'LABEL_0' then 'O' when 'LABEL_1' then 'B-PRODUCT'
               when 'LABEL_2' then 'I-PRODUCT' end as label, count(*) as tokens from named group by 1, 2""",
    "first_n_texts": f"with {POSTS} select id, text from posts order by id limit {rules.HIGHLIGHTED_TEXTS}",
    # H
    "vendor_groups": f"with {SCORED} select vendor, count(*) as posts from scored group by vendor",
    "posts_per_week": f"with {SCORED} select vendor, {PER_WEEK} as posts_per_week from scored group by vendor",
    "avg_views": f"with {SCORED} select vendor, {AVG_VIEWS} as avg_views from scored group by vendor",
    "parse_entities": f"""with {MESSAGES}
        select id, 0 as pos, 'I-PRICE' as label, '5' as word, '5' as price from messages where ent_word is not null
        union all
        select id, 1, 'B-PRODUCT', ent_word, cast(ent_price as varchar) || ' ETB' from messages
        where ent_word is not null
        union all
        select id, 2, 'I-PRODUCT', 'x' || chr(160) || 'y', null from messages
        where ent_word is not null and id % 7 = 1""",
    "avg_price": f"""with {SCORED} select vendor, coalesce({rounded('avg(ent_price)')}, 0) as avg_price
        from scored group by vendor""",
    "top_post": f"with {SCORED} select vendor, message, views from scored qualify {TOP}",
    "top_product": f"""with {SCORED} select vendor, coalesce(ent_word, '') as top_product,
        coalesce(ent_price, 0) as top_price from scored qualify {TOP}""",
    "lending_score": f"""with {SCORED}, v as (
          select vendor, {AVG_VIEWS} as a, {PER_WEEK} as p from scored group by vendor)
        select vendor, {rounded('a * 0.5 + p * 0.5')} as lending_score from v""",
    "vendor_scorecard": f"""with {SCORED}, v as (
          select vendor, {AVG_VIEWS} as avg_views, {PER_WEEK} as posts_per_week,
                 coalesce({rounded('avg(ent_price)')}, 0) as avg_price from scored group by vendor),
        t as (select vendor, coalesce(ent_word, '') as top_product, coalesce(ent_price, 0) as top_price
              from scored qualify {TOP})
        select vendor, avg_views, posts_per_week, avg_price, top_product, top_price,
               {rounded('avg_views * 0.5 + posts_per_week * 0.5')} as lending_score from v join t using (vendor)""",
    # I
    "channel_counts": f"with {POSTS} select channel_username, count(*) as messages from posts group by 1",
    "raw_vs_clean": f"""with {POSTS}, r as (
          select channel_username, count(*) as n from posts group by 1),
        c as (select channel_username, count(*) as n from ({CLEAN}) group by 1)
        select channel_username, coalesce(r.n, 0) as raw_count, coalesce(c.n, 0) as cleaned_count
        from r full join c using (channel_username)""",
    "head_per_channel": f"""with {POSTS} select channel_username, id, message from posts
        where channel_username in ({CHANNEL_LIST})
        qualify row_number() over (partition by channel_username order by id) <= {rules.PREVIEW_ROWS}""",
    "image_counts": rf"""{IMAGES} select regexp_extract(image, '^(.*)_\d+\.jpg$', 1) as channel,
        count(*) as images from images group by 1""",
    "image_counts_compat": f"""{IMAGES} select split_part(image, '_', 1) as channel, count(*) as images
        from images group by 1""",
    # J
    "stream_ingest": streamed("channel_username") + f" where channel_username in ({CHANNEL_LIST})",
    "stream_dedup": streamed(STRIPPED),
    "stream_clean": f"with {POSTS} {CLEAN}",
    # K
    "apply_text_fn": per_post(normalized("text")),
    "map_batches": ALIGNED_SELECT,
    "apply_per_vendor": f"""with {POSTS} select channel_title as vendor, {AVG_VIEWS} as avg_views
        from posts group by 1""",
}
