"""Common table expressions for the SQL side of ``__spark_entry__``.

The stemmer here is written from the published algorithm with regular expressions and
tables of its own, apart from the one in ``rankdex.functions.porter``, so that each
checks the other.
"""

from __future__ import annotations

# The suffixes of the published steps 2, 3 and 4.
STEP_2 = dict(
    pair.split(":")
    for pair in (
        "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e "
        "ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous "
        "aliti:al iviti:ive biliti:ble logi:log"
    ).split()
)
STEP_3 = dict(
    pair.split(":") for pair in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split()
)
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize"
).split()  # and "ion" after s or t


def PAIRING(order: str) -> str:  # noqa: N802
    return f"""
    docs as (select doc_id, row_number() over (order by {order}, doc_id) - 1 ix from documents),
    nodes as (
        select node_id social_id, row_number() over (order by followers desc, node_id) - 1 ix
        from (select l_partkey node_id, count(*) followers from lineitem group by 1)),
    paired as (select ix, doc_id, social_id from docs join nodes using (ix))"""


WORDS = r"""
    words as (
        select distinct doc_id, unnest(regexp_extract_all(lower(text), '(\p{L}+)', 1)) w
        from documents)"""

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_SOME = f"^({_C})?{_V}{_C}"  # measure above 0
_TWO = f"^({_C})?{_V}{_C}{_V}{_C}"  # measure above 1
_ONE = f"^({_C})?{_V}{_C}({_V})?$"  # measure 1
_VOWEL = f"^({_C})?[aeiouy]"
_SHORT = f"^{_C}[aeiouy][^aeiouwxy]$"


def _replace(suffixes: dict[str, str], measure: str) -> str:
    """The longest suffix decides, whether or not its stem is long enough."""
    cases = ""
    for suffix in sorted(suffixes, key=len, reverse=True):
        rest = f"left(s, length(s) - {len(suffix)})"
        cases += (
            f" when regexp_matches(s, '.{suffix}$') then case when regexp_matches({rest}, "
            f"'{measure}') then {rest} || '{suffixes[suffix]}' else s end"
        )
    return cases


def _stems(words: str) -> str:
    """``stems(w, s)`` for the words of the query ``words``."""
    cut = "left(s, length(s) - {})".format
    return f"""
    st0 as (select w, case when length(w) < 3 then null
        else regexp_replace(w, '^y', 'Y') end s from ({words})),
    st1 as (select w, case
        when regexp_matches(s, '.(ss|i)es$') then {cut(2)}
        when regexp_matches(s, '.[^s]s$') then {cut(1)} else s end s from st0),
    st2 as (select w, s like '%eed' and length(s) > 3 eed,
        case when regexp_matches(s, '.ed$') then {cut(2)}
             when regexp_matches(s, '.ing$') then {cut(3)} end t, s from st1),
    st3 as (select w, case
        when eed then case when regexp_matches({cut(3)}, '{_SOME}') then {cut(1)} else s end
        when t is null or not regexp_matches(t, '{_VOWEL}') then s
        when regexp_matches(t, '(at|bl|iz)$') then t || 'e'
        when right(t, 1) = substr(t, length(t) - 1, 1) and length(t) > 1
            and regexp_matches(t, '[^aeiouylsz]$') then left(t, length(t) - 1)
        when regexp_matches(t, '{_SHORT}') then t || 'e' else t end s from st2),
    st4 as (select w, case when regexp_matches(s, '.y$') and regexp_matches({cut(1)}, '{_VOWEL}')
        then {cut(1)} || 'i' else s end s from st3),
    st5 as (select w, case {_replace(STEP_2, _SOME)} else s end s from st4),
    st6 as (select w, case {_replace(STEP_3, _SOME)} else s end s from st5),
    st7 as (select w, case {_replace(dict.fromkeys(STEP_4, ''), _TWO)}
        when regexp_matches(s, '.[st]ion$') and regexp_matches({cut(3)}, '{_TWO}')
        then {cut(3)} else s end s from st6),
    st8 as (select w, case when regexp_matches(s, '.e$') and (regexp_matches({cut(1)}, '{_TWO}')
        or (regexp_matches({cut(1)}, '{_ONE}') and not regexp_matches({cut(1)}, '{_SHORT}')))
        then {cut(1)} else s end s from st7),
    st9 as (select w, case when s like '%ll' and regexp_matches(s, '{_TWO}')
        then {cut(1)} else s end s from st8),
    stems as (select w, coalesce(lower(s), w) s from st9)"""


STEMMED_INDEX = rf"""{WORDS},
    {_stems(r'''select w from words
        union select unnest(string_split(lower(regexp_replace(text, '[^\p{L}]+', ' ', 'g')), ' '))
        from benchmark''')},
    idx as (select distinct s keyword, doc_id from words join stems using (w))"""

QUERIES = r"""
    q as (select item_id query_id, regexp_replace(text, '[^\p{L}]+', ' ', 'g') query
        from benchmark)"""

_TERMS = """
    q_words as (
        select query_id, list_filter(string_split(lower(query), ' '), lambda x: x <> '')[1:15] l
        from q),
    t as (
        select query_id, unnest(l) w, generate_subscripts(l, 1) - 1 pos from q_words)"""

_MATCHES = f"""{_TERMS},
    m as (select query_id, pos, doc_id from t join words_of using (w) join idx using (keyword))"""


def _hits(stem: bool) -> str:
    words_of = "select w, s keyword from stems" if stem else "select distinct w, w keyword from words"
    return f"""words_of as ({words_of}), {_MATCHES},
    first as (select query_id, doc_id, min(pos) pos from m group by 1, 2),
    hits as (select query_id, doc_id,
        cast(row_number() over (partition by query_id order by pos, doc_id) as integer) rk
        from first)"""


HITS = _hits(stem=True)
UNSTEMMED_HITS = _hits(stem=False)


def COMPAT_HITS(page: int) -> str:  # noqa: N802
    return f"""words_of as (select w, s keyword from stems), {_MATCHES},
    bag as (select query_id, doc_id,
        row_number() over (partition by query_id order by pos, doc_id) o from m),
    first as (select query_id, doc_id, min(o) o from bag where o >= {15 * (page - 1)} group by 1, 2),
    hits as (select query_id, doc_id, cast({15 * (page - 1)} +
        row_number() over (partition by query_id order by o) as integer) rk from first)"""


def page_sql(page: int, compat: bool = False) -> str:
    low = 15 * (page - 1) + 1
    hits = COMPAT_HITS(page) if compat else HITS
    return f"""with {STEMMED_INDEX}, {QUERIES}, {hits},
    shown as (select *, max(rk) over (partition by query_id) high
        from hits where rk between {low} and {low + 14})
    select query_id, doc_id, rk as "rank", {page} page, {low} low, high, lang, n_chars
    from shown join documents using (doc_id)"""
