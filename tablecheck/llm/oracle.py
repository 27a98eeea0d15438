"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from tablecheck.llm.quality_rules import RULES, STOP_WORDS

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))


def _bound(name: str) -> str:
    rule = next(r for r in RULES if r.name == name)
    return str(rule.low if rule.low is not None else rule.high)


_QUALITY_RULES = rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, {_WORDS.format("text")} as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
windows as (select r, unnest(list_transform(range(1, len(w) - 6), lambda i: {{'i': i, 'x': array_to_string(w[i:i + 7], ' ')}})) as p from w where len(w) >= 8),
twice as (select r, unnest(list(i)) as i from (select r, p.i as i, p.x as x from windows) group by r, x having count(*) > 1),
covered as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from twice) group by r),
m as (select w.r, doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
        len(l) as n_lines, length(regexp_replace(text, '\P{{L}}', '', 'g')) as n_letters, length(regexp_replace(text, '\P{{Lu}}', '', 'g')) as n_upper,
        len(list_filter(w, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) in ({_STOPS}))) as n_stops
      from w left join covered c on c.r = w.r),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars / n_words between 1.5 and {next(r.high for r in RULES if r.name == "long_words")} and n_symbols / n_words <= {_bound("symbols")}
  and coalesce(n_upper / nullif(n_letters, 0), 0) <= {_bound("shouting")} and n_stops / n_words >= {_bound("no_stop_words")}
  and n_dup_lines / n_lines <= {_bound("line_copies")} as kept
from b
"""

_NEAR_DUPLICATES = rf"""
with recursive w as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
reach(node, low) as (select a, a from e union select reach.node, e.b from reach join e on e.a = reach.low),
low as (select node, min(low) as low from reach group by node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(low.low, d.doc_id) as component_id, coalesce(low.low, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join low on low.node = d.doc_id
"""

_PHRASE_COUNTING = r"""
with p as (select coalesce(lang,'und') as lang, unnest(string_split_regex(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[.,;:!?\x0A-\x0D]')) as p from documents),
w as (select lang, regexp_extract_all(p,'[^\x20\x09]+') as w from p),
g as (select lang, m as length, unnest(list_transform(range(1, len(w)-m+2), lambda i: array_to_string(w[i:i+m-1],' '))) as phrase from w, (values (1),(2),(3)) v(m) where len(w)>=m),
c as (select lang, length, phrase, count(*) as f from g group by all),
n as (select lang, cast(sum(f) as bigint) as n from c where length=1 group by lang),
k as (select lang, length, phrase, f as a, string_split(phrase,' ') as w from c where length>1 and f>=10),
cut as (select k.*, i, array_to_string(w[1:i],' ') as x, array_to_string(w[i+1:],' ') as y from k, (values (1),(2)) v(i) where i<length),
s as (select cut.*, l.f as l, r.f as r, cast((cast(1000000 as hugeint)*a*a)//(cast(l.f as hugeint)*r.f) as bigint) as score from cut join c l on l.lang=cut.lang and l.phrase=x join c r on r.lang=cut.lang and r.phrase=y),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, i)=1),
o as (select lang, phrase, max(f) as f from (select lang, unnest([array_to_string(w[1:2],' '),array_to_string(w[2:3],' ')]) as phrase, a as f from k where length=3) group by all),
d as (select b.* from b left join o on o.lang=b.lang and o.phrase=b.phrase where o.f is null or 100*o.f<50*a),
z as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from d)
select z.lang, rank, phrase, a, l, r, n, score from z join n on n.lang=z.lang where rank<=2000
"""

_SOURCE_DIVERGENCE = r"""
with t as (select row_number() over () as r, coalesce(lang,'') as lang, coalesce(source,'') as source, translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz') as text from documents),
o as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from t),
k as (select lang, term from o group by all having count(distinct r) >= 30),
v as (select lang, count(*) as v from k group by lang),
g as (select lang, source, coalesce(v.v,0) as v from (select distinct lang, source from t) left join v using (lang)),
c as (select lang, source, term, count(*) as n from o semi join k using (lang, term) group by all),
s as (select lang, source, sum(n) as s from c group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n,0) as n, 1+(1000000000::hugeint*(coalesce(c.n,0)+5))//(coalesce(s.s,0)+5*g.v) as p
  from g join k using (lang) left join c on c.lang=g.lang and c.source=g.source and c.term=k.term left join s on s.lang=g.lang and s.source=g.source),
q as (select lang, term, 1+(1000000000::hugeint*(sum(n)+5))//(any_value(w.w)+5*any_value(v.v)) as q from c join (select lang, sum(s) as w from s group by lang) w using (lang) join v using (lang) group by lang, term),
pair as (select a.lang, a.source, b.source as item, sum(abs(a.p-b.p)) as value from p a join p b on a.lang=b.lang and a.term=b.term and a.source<>b.source group by all),
pairs as (select a.lang, a.source, b.source as item, coalesce(pair.value,0) as value from g a join g b on a.lang=b.lang and a.source<>b.source left join pair on pair.lang=a.lang and pair.source=a.source and pair.item=b.source),
terms as (select p.lang, p.source, p.term as item, p.p-q.q as value from p join q using (lang, term) where p.n>0 and p.p>q.q),
u as (select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms),
r as (select lang, source, part, item, cast(value as bigint) as value, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from u)
select * from r where part='pair' or rank<=50
"""

ORACLES = {
    "op9_quality_rules": _QUALITY_RULES,
    "op10_near_duplicates": _NEAR_DUPLICATES,
    "op12_phrase_counting": _PHRASE_COUNTING,
    "op13_source_divergence": _SOURCE_DIVERGENCE,
}
