"""DuckDB SQL for the queries that SQL can express, over the given tables.

It borrows nothing from the operators but the texts of known licences, which are fixed values; how they are made canonical is said here anew.
"""

from __future__ import annotations

from functools import cache
from hashlib import sha256

import regex

from usertide.llm.licences import known_texts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OP6_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP6 = f"""
with docs as (select doc_id, {_OP6_WORDS} as w from documents),
items as (select cast(item_id as varchar) as item, {_OP6_WORDS} as w from benchmark),
windows as (
    select distinct item, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as g
    from items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0
),
places as (
    select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as g
    from docs, (select distinct n from windows) as lengths, unnest(range(1, len(w) - n + 2)) as u(i)
),
hits as (select doc_id, i, n, item from places join windows using (n, g)),
covered as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as u(p) group by doc_id),
named as (
    select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids
    from hits group by doc_id
)
select docs.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (doc_id) left join named using (doc_id)
"""

_OP9 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_LF = "chr(10)"

_OP1 = rf"""
with recursive said as (
    select conv_id, turn, role, text, case when turn % 3 = 2 then turn - 2 else turn - 1 end as t1 from conversations
),
mail as (
    select a.conv_id, a.turn,
        coalesce(a.text, '')
        || coalesce({_LF} || {_LF} || 'On turn ' || b.turn || ' the ' || coalesce(b.role, '?') || ' wrote:' || {_LF}
            || '> ' || replace(coalesce(b.text, ''), {_LF}, {_LF} || '> '), '')
        || coalesce({_LF} || '> On turn ' || c.turn || ' the ' || coalesce(c.role, '?') || ' wrote:' || {_LF}
            || '>> ' || replace(coalesce(c.text, ''), {_LF}, {_LF} || '>> '), '') as text
    from said a
    left join said b on b.conv_id = a.conv_id and b.turn = a.t1
    left join said c on c.conv_id = b.conv_id and c.turn = b.t1
),
lines as (
    select conv_id, turn, i, parts[i] as line
    from (select conv_id, turn, string_split(text, {_LF}) as parts from mail), unnest(range(1, len(parts) + 1)) as u(i)
),
levels as (
    select conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) as level,
        regexp_replace(line, '^([ \t]*>)+[ \t]?', '') as said
    from lines
),
blanks as (
    select *, trim(said) = '' or (regexp_matches(said, '(?i)^.*\b(wrote|schrieb|a écrit|escribió)\b.*:[ \t]*$')
            and coalesce(lead(level) over w, 0) > level) as blank,
        lag(level) over w is distinct from level as other
    from levels window w as (partition by conv_id, turn order by i)
),
numbered as (
    select *, sum(case when blank or other then 1 else 0 end) over (partition by conv_id, turn order by i) as k from blanks
),
passages as (
    select conv_id, turn, k, any_value(level) as level, trim(string_agg(said, {_LF} order by i)) as said
    from numbered where not blank group by conv_id, turn, k
),
hashed as (select *, trim(regexp_replace(lower(said), '\s+', ' ', 'g')) as plain from passages),
first_said as (select conv_id, plain, min(turn) as source from hashed where level = 0 group by conv_id, plain),
links as (
    select h.conv_id, h.turn, h.k, h.level, f.source
    from hashed h join first_said f on f.conv_id = h.conv_id and f.plain = h.plain
    where h.level > 0 and f.source < h.turn
),
votes as (select conv_id, turn, source, count(*) as n from links where level = 1 group by all),
parents as (
    select conv_id, turn, source as parent from votes
    qualify row_number() over (partition by conv_id, turn order by n desc, source desc) = 1
),
threads as (
    select conv_id, turn, turn as thread, 0 as depth from mail anti join parents using (conv_id, turn)
    union all
    select p.conv_id, p.turn, t.thread, t.depth + 1
    from threads t join parents p on p.conv_id = t.conv_id and p.parent = t.turn
),
counts as (
    select conv_id, turn, count(*) filter (level > 0) as quoted,
        coalesce(string_agg(said, {_LF} || {_LF} order by k) filter (level = 0), '') as own
    from passages group by conv_id, turn
),
sources as (
    select conv_id, turn, count(*) as linked,
        array_to_string(list_sort(list_distinct(list(source))), ',') as sources
    from links group by conv_id, turn
)
select m.conv_id, m.turn, p.parent, t.thread, cast(t.depth as bigint) as depth, coalesce(c.quoted, 0) as quoted,
    coalesce(s.linked, 0) as linked, coalesce(s.sources, '') as sources, sha256(coalesce(c.own, '')) as own_sha256
from mail m left join parents p using (conv_id, turn) left join threads t using (conv_id, turn)
left join counts c using (conv_id, turn) left join sources s using (conv_id, turn)
"""

#: Spellings that count as the same word.
_OTHER_SPELLINGS = """
acknowledgement acknowledgment
analogue analog
analyse analyze
artefact artifact
authorisation authorization
authorised authorized
calibre caliber
cancelled canceled
catalogue catalog
centre center
emphasised emphasized
favour favor
favourite favorite
fulfil fulfill
fulfilment fulfillment
http https
initialise initialize
judgement judgment
labelling labeling
labour labor
licence license
licenced licensed
maximise maximize
modelled modeled
modelling modeling
offence offense
optimise optimize
organisation organization
organise organize
practise practice
programme program
realise realize
recognise recognize
signalling signaling
utilisation utilization
whilst while
wilful willful
"""
_SPELL = dict(x.split() for x in _OTHER_SPELLINGS.split("\n") if x)

#: Lines that are notices of copyright, whatever follows: signs, years, "all rights reserved" alone, by how the line goes on.
_LEAD = r"(?i)^[^\p{L}\p{N}]*"
_SIGN = r"[^\p{L}\p{N}]*([0-9]{4}\b|copyright\b|©|\(c\))"
_NOTICE = [
    _LEAD + "©",
    _LEAD + r"(copyright\b|\(c\))" + _SIGN,
    _LEAD + r"\(c\).*\b(19|20)[0-9]{2}[^\p{L}\p{N}]*(all rights reserved[^\p{L}\p{N}]*)?$",
    _LEAD + r"all rights reserved[^\p{L}\p{N}]*$",
]
#: Lines that begin with the word name somebody, unless nothing, a mark, or one of these words of licences comes next.
_NAMED = _LEAD + r"copyright\b"
_GOES_ON = (
    "notice notices holder holders owner owners ownership law laws license licence licenses licences statement statements permission "
    "permissions protection treaty treaties interest interests right rights disclaimer disclaimers doctrine doctrines status term terms "
    "infringement infringements information management legend legends work works and or on in to for is are as of at that which if unless "
    "when where with without not nor under also like does resulting"
).split()
_UNNAMED = (
    _NAMED + r"([^\p{L}\p{N}]*$|\s*[-,;.)\"”'’/]|[^\p{L}\p{N}]+((" + "|".join(_GOES_ON) + r")\b|the (software|library|program|work)\b|the[^\p{L}\p{N}]*$))"
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    """SQL for the canonical form of one line, word by word."""
    spell = ", ".join(f"'{a}': '{b}'" for a, b in _SPELL.items())
    plain = f"trim(regexp_replace(lower({line}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    words = f"list_transform(string_split({plain}, ' '), lambda w: coalesce(map {{{spell}}}[w], w))"
    gone = [f"regexp_matches({line}, {_quoted(x)})" for x in _NOTICE]
    gone.append(f"(regexp_matches({line}, {_quoted(_NAMED)}) and not regexp_matches({line}, {_quoted(_UNNAMED)}))")
    return f"case when {' or '.join(gone)} then '' else array_to_string({words}, ' ') end"


def _digest(plain: str) -> str:
    """SQL for the digest of canonical words: points between numbers, no blanks."""
    pointed = plain
    for _ in range(2):  # a number between two others is in two pairs
        pointed = f"regexp_replace({pointed}, '(\\p{{N}}) (\\p{{N}})', '\\1.\\2', 'g')"
    return f"sha256(replace(replace(replace({pointed}, ' ', ''), 'copyrightholder', 'copyrightowner'), 'licence', 'license'))"


def _known() -> str:
    """``licence, digest, whole_only`` of the known texts as SQL values."""
    found: dict[str, list] = {}
    for licence, text, whole_only in known_texts():
        lines = []
        for line in text.split("\n"):
            named = regex.search(_NAMED, line) and not regex.search(_UNNAMED, line)
            if not named and not any(regex.search(x, line) for x in _NOTICE):
                lines += [_SPELL.get(w, w) for w in regex.findall(r"[\p{L}\p{N}]+", line.lower())]
        plain = regex.sub(r"(?<=\p{N}) (?=\p{N})", ".", " ".join(lines)).replace(" ", "")
        plain = plain.replace("copyrightholder", "copyrightowner").replace("licence", "license")
        if plain:
            row = found.setdefault(sha256(plain.encode()).hexdigest(), [licence, True])
            row[1] &= whole_only
    return ", ".join(f"('{licence}', '{digest}', {whole_only})" for digest, (licence, whole_only) in found.items())


@cache
def _op7() -> str:
    return f"""
with known(licence, digest, whole_only) as (values {_known()}),
lines as (
    select doc_id, i, {_canonical("parts[i]")} as plain
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents), unnest(range(1, len(parts) + 1)) as u(i)
),
whole as (select doc_id, {_digest("string_agg(plain, ' ' order by i)")} as digest from lines where plain <> '' group by doc_id),
notices as (
    select doc_id, count(*) as n, string_agg(distinct licence, ',' order by licence) as names
    from (select doc_id, {_digest("plain")} as digest from lines where plain <> '') join known using (digest) where not whole_only group by doc_id
)
select d.doc_id, k.licence, coalesce(n.names, '') as notices, coalesce(n.n, 0) as n_notices
from documents d left join whole w using (doc_id) left join known k using (digest) left join notices n on n.doc_id = d.doc_id
"""


_USABLE = "embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

_OP11 = f"""
with recursive v as (
    select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
    where {_USABLE} and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.93
),
reach as (select vec_id as x, vec_id as r from embeddings union select reach.x, links.y from reach join links on links.x = reach.r),
components as (select x, min(r) as component_id from reach group by x),
degrees as (select x, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join components on components.x = vec_id left join degrees on degrees.x = vec_id
"""

_OP13 = f"""
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
    from embeddings where {_USABLE}
),
scores as (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
),
near as (
    select anchor_id, other as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select anchor_id, positive_id, cast(row_number() over hardest as integer) as rank, other as negative_id, positive_score, score as negative_score
from near join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
window hardest as (partition by anchor_id, positive_id order by score desc, other)
qualify row_number() over hardest <= 5
"""

_OP12 = r"""
with recursive bits as (
    select n, 0 as i, n as v from (select cast(range as bigint) as n from range(256))
    union all
    select n, i + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where i < 8
),
crcs as (
    select c, cast(c as varchar) as s, 0 as i, cast(4294967295 as bigint) as v from (select distinct conv_id as c from conversations where conv_id is not null)
    union all
    select c, s, i + 1, xor(crcs.v >> 8, step.v) from crcs
    join (select n, v from bits where i = 8) step on step.n = xor(crcs.v, cast(ascii(substr(s, crcs.i + 1, 1)) as bigint)) & 255
    where crcs.i < length(s)
),
convs as (select c, xor(v, 4294967295) % 4 as h, c - c % 20 as base from crcs where i = length(s)),
turns as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as i, coalesce(text, '') as text,
        length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') as said
    from conversations
),
sequence as (
    select convs.c, i, 0 as own, text, said from convs join turns on turns.c = base and i <= h
    union all
    select convs.c, i, 1, text, said from convs join turns on turns.c = convs.c and i > h
),
placed as (select c, row_number() over (partition by c order by own, i) as p, text, said from sequence),
prefixes as (
    select c, p, string_agg(sha256(said), '') over (partition by c order by p) as key, string_agg(sha256(said), '') over (partition by c order by p rows between unbounded preceding and 1 preceding) as up,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
    from placed
    union all
    select c, 0, '', null, 0 from convs
),
members as (select c, p, key, case when p = 1 then '' else up end as up, words, p = max(p) over (partition by c) as last from prefixes),
nodes as (
    select p as depth, key, any_value(up) as up, any_value(words) as words, min(c) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (last), '')) as ends_sha256
    from members group by p, key
),
counted as (select nodes.*, (select count(*) from nodes below where below.depth = nodes.depth + 1 and below.up = nodes.key) as n_children from nodes),
sums as (
    select above.p as depth, above.key, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * counted.words) as saved
    from counted join members above on above.c = conv_id and above.p <= depth group by above.p, above.key
)
select counted.conv_id, counted.depth, parent.conv_id as parent_conv_id, counted.n_convs, counted.n_children, n_leaves,
    cast(saved as bigint) as saved_tokens, counted.ends_sha256
from counted join sums on sums.depth = counted.depth and sums.key = counted.key
left join nodes parent on parent.depth = counted.depth - 1 and parent.key = counted.up
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quote_linking": _OP1,
        "op6_decontaminate": _OP6,
        "op7_licence_scan": _op7(),
        "op9_exact_dedup": _OP9,
        "op11_embedding_dedup": _OP11,
        "op12_prefix_trie": _OP12,
        "op13_hard_negatives": _OP13,
    }
