"""SQL of the queries that SQL can express, for DuckDB."""

# Each text with markers of 12 (start), 10 (body) and 10 (end) characters around it, and one
# character more for every control string in it.
_CONTROL = (
    r"<!*\|im_start\|>|<!*\|im_sep\|>|<!*\|im_end\|>|<!*s>|<!*/s>|\[!*INST\]|\[!*/INST\]|<!*<SYS>>|<!*</SYS>>"
    r"|<!*\|endoftext\|>|<!*\|begin_of_text\|>|<!*\|end_of_text\|>|<!*\|eot_id\|>"
    r"|<!*\|start_header_id\|>|<!*\|end_header_id\|>"
)

SQL_CHAT = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, turn, role, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) t(turn, role)
), sized as (
    select *, 32 + length(role) + length(text)
        + len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}')) as chars
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), ''))
        as loss_sha256,
    cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"coalesce(regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL_DECONTAMINATION = f"""
with docs as (select doc_id, {_WORDS.format("text")} as words from documents),
items as (select item_id, {_WORDS.format("text")} as words from benchmark),
windows as (
    select distinct item_id, words[i:i + 9] as win
    from (select item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) as i
          from items where len(words) > 0)
),
lengths as (select distinct len(win) as k from windows),
occurring as (
    select doc_id, i, k, words[i:i + k - 1] as win
    from (select doc_id, words, k, unnest(generate_series(1, len(words) - k + 1)) as i
          from docs, lengths where len(words) >= k)
),
hits as (select o.doc_id, o.i, o.k, w.item_id from occurring o join windows w on o.win = w.win),
hit_words as (
    select doc_id, count(distinct p) as n from (
        select doc_id, unnest(generate_series(i, i + k - 1)) as p from (select distinct doc_id, i, k from hits))
    group by doc_id
),
hit_items as (
    select doc_id, count(*) as n, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(w.n, 0) as n_hit, coalesce(i.n, 0) as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(w.n, 0) > 0 as contaminated
from docs d left join hit_words w on d.doc_id = w.doc_id left join hit_items i on d.doc_id = i.doc_id
"""

_HOST = r"lower(regexp_replace(regexp_replace(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':\d*$|\.$', ''))"

SQL_URL_FILTER = rf"""
with captures as (
    select page_id, {_HOST.format("trim(url)")} as host, ts as fetched_at,
        regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1) as segment
    from pages left join events on page_id = event_id
), entries as (
    select list_key, ts as valid_from, max(case event_type when 'error' then 'block' when 'purchase' then 'remove'
        else 'allow' end) as action
    from events join (select page_id, regexp_replace({_HOST.format("trim(url)")}, '^(www|m|blog)\.', '') as list_key
                      from pages) on page_id = user_id
    where list_key <> '' and ts is not null and event_type is not null group by 1, 2
), keys as (
    select page_id, fetched_at, 0 as rank, host || '/' || segment as list_key from captures where segment <> ''
    union all
    select page_id, fetched_at, i as rank, list_aggregate(string_split(host, '.')[i:], 'string_agg', '.')
    from (select *, unnest(generate_series(1, greatest(len(string_split(host, '.')) - 1, 1))) as i from captures
          where host <> '')
), active as (
    select page_id, rank, k.list_key, action, valid_from
    from keys k asof join entries e on k.list_key = e.list_key and k.fetched_at >= e.valid_from
), best as (
    select * from active where action <> 'remove'
    qualify row_number() over (partition by page_id order by rank) = 1
)
select c.page_id, host, strftime(fetched_at, '%Y-%m-%d %H:%M:%S.%f') as fetched_at,
    coalesce(action, 'allow') as action, list_key as matched_key,
    strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') as listed_since
from captures c left join best b on c.page_id = b.page_id
"""

# CRC-32 of a decimal number's digits, a bit at a time.
_CRC32 = (
    "xor(list_reduce(list_transform(string_split(cast({0} as varchar), ''), lambda d: cast(ascii(d) as bigint)), "
    "lambda crc, byte: list_reduce(range(8), lambda r, i: case when r & 1 = 1 then xor(r >> 1, 3988292384) "
    "else r >> 1 end, xor(crc, byte)), 4294967295), 4294967295)"
)
_ENCODED = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"


def _record(n_chars: str) -> str:
    return "sha256(" + " || ".join(_ENCODED.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# A step is a sibling's digest, L or R by the side where it stands, or N where there is none.
SQL_MERKLE = f"""
with recursive leaves as (
    select doc_id, lang, {_record("n_chars")} as leaf,
        case when {_CRC32.format("doc_id")} % 7 = 0 then {_record("(cast(n_chars as decimal(20,0)) + 1)")}
            else {_record("n_chars")} end as changed
    from documents
), placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by lang) as n
    from leaves
), lower as (
    select lang, 0 as level, pos, leaf as digest, n from placed
    union all
    select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2
    from lower where n > 1 group by lang, level, pos // 2, n
), subroots as (
    select lang, digest as subroot, level as height, row_number() over (order by lang nulls first) - 1 as pos,
        count(*) over () as n
    from lower where n = 1
), upper as (
    select 0 as level, pos, subroot as digest, n from subroots
    union all
    select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2
    from upper where n > 1 group by level, pos // 2, n
), root as (select digest as root, level as height from upper where n = 1),
upper_steps as (
    select s.lang, list(coalesce(case when (s.pos >> t.l) & 1 = 1 then 'L' else 'R' end || u.digest, 'N') order by t.l) as steps
    from subroots s, root r, (select unnest(range(64)) as l) t
    left join upper u on u.level = t.l and u.pos = xor(s.pos >> t.l, 1)
    where t.l < r.height group by s.lang
), lower_steps as (
    select p.lang, p.pos,
        list(coalesce(case when (p.pos >> t.l) & 1 = 1 then 'L' else 'R' end || w.digest, 'N') order by t.l) as steps
    from placed p join subroots s on p.lang is not distinct from s.lang, (select unnest(range(64)) as l) t
    left join lower w on w.lang is not distinct from p.lang and w.level = t.l and w.pos = xor(p.pos >> t.l, 1)
    where t.l < s.height group by p.lang, p.pos
), paths as (
    select p.*, s.subroot, r.root, list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) as steps
    from placed p join subroots s on p.lang is not distinct from s.lang cross join root r
    left join lower_steps a on a.lang is not distinct from p.lang and a.pos = p.pos
    left join upper_steps b on b.lang is not distinct from p.lang
), done as (
    select *, list_reduce(steps, lambda d, s: sha256(
        case s[1] when 'L' then s[2:] || d when 'R' then d || s[2:] else d end), changed) as folded_root
    from paths
)
select doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(steps, lambda s: s[2:]), 'string_agg', ''), ''))
    as proof_sha256, folded_root, folded_root = root as verified
from done
"""

SQL_PREFIX_TRIE = rf"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as place
    from conversations where conv_id is not null
), plans as (
    select distinct conv_id, conv_id - conv_id % 20 as base, {_CRC32.format("conv_id")} % 4 as head from turns
), rebuilt as (
    select p.conv_id, place, {{'role': role, 'text': text}} as turn from plans p join turns t on t.conv_id = base and place <= head
    union all
    select p.conv_id, place, {{'role': role, 'text': text}} from plans p join turns t on t.conv_id = p.conv_id and place > head
), sequences as (
    select p.conv_id, coalesce(list(turn order by place) filter (where place is not null), []) as turns
    from plans p left join rebuilt r on r.conv_id = p.conv_id group by p.conv_id
), prefixes as (
    select conv_id, len(turns) as whole, depth, turns[1:depth] as node
    from (select *, unnest(range(len(turns) + 1)) as depth from sequences)
), nodes as (
    select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where whole = depth), '')) as ends_sha256,
        (count(*) - 1) * case when depth = 0 then 0 else len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) end as share
    from prefixes group by node, depth
), families as (
    select n.node, any_value(p.conv_id) as parent_conv_id, count(distinct c.node) as n_children
    from nodes n left join nodes p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]
    left join nodes c on c.depth = n.depth + 1 and c.node[1:n.depth] = n.node
    group by n.node
), subtrees as (
    select n.node, count(*) filter (where f.n_children = 0) as n_leaves, cast(sum(d.share) as bigint) as saved_tokens
    from nodes n join nodes d on d.depth >= n.depth and d.node[1:n.depth] = n.node join families f on f.node = d.node
    group by n.node
)
select n.conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from nodes n join families f on f.node = n.node join subtrees s on s.node = n.node
"""

SQL_LINE_DEDUP = f"""
with lines as (
    select doc_id, unnest(range(1, len(parts) + 1)) as place, unnest(parts) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
    select *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines
), frequent as (
    select key, max(doc_id) as holder from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
    select k.*, holder is not null and holder <> doc_id as gone from keyed k left join frequent f on f.key = k.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
