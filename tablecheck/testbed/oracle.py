"""The registered queries as SQL for DuckDB, on the tables as views."""

from __future__ import annotations

from collections.abc import Sequence

from .pairs import (
    CUSTOM_COLUMN,
    CUSTOM_ROW,
    CUSTOMER,
    DISJOINT,
    DRILL_GROUPS,
    EVENTS,
    FILTERED,
    INVENTORY,
    LINEITEM,
    N_BUCKETS,
    MIXED_NUMBERS,
    ORDERS,
    PADDED,
    RELAXED,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    SUPPLIER,
    DerivedPair,
)

# How each column is summarised: numbers have sums, text and times only an order.
NUMBERS = {
    "c_custkey", "c_nationkey", "c_acctbal", "o_orderkey", "o_custkey", "o_totalprice", "event_id",
    "user_id", "value", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "s_suppkey", "s_acctbal",
}
FLOATS = {"c_acctbal", "o_totalprice", "value", "l_quantity", "l_extendedprice", "l_discount",
          "s_acctbal"}

EVENTS_FILTER_SQL = "ts >= TIMESTAMP '2024-01-01 12:00:00' and event_type <> 'error'"


def row_text(columns: Sequence[str]) -> str:
    parts = [f"coalesce(cast({c} as varchar),'NULL')" for c in columns]
    return " || '||' || ".join(parts) if parts else "''"


def row_hash(columns: Sequence[str]) -> str:
    return f"sha256({row_text(columns)})"


def strict_hash(columns: Sequence[str]) -> str:
    parts = [
        f"case when {c} is null then 'N' else 'V' || cast(length(cast({c} as varchar)) as varchar)"
        f" || ':' || cast({c} as varchar) end"
        for c in columns
    ]
    return f"sha256({' || '.join(parts)})"


def sides(pair: DerivedPair, where: str = "true") -> str:
    return (
        f"src as (select * from ({pair.sql('source')}) a where {where}), "
        f"tgt as (select * from ({pair.sql('target')}) b where {where})"
    )


def diff_ctes(
    pair: DerivedPair,
    where: str = "true",
    within: Sequence[str] = (),
    prefix: str = "",
    hashed: Sequence[str] | None = None,
) -> str:
    """``diff``: the differing keys with class and hashes.  Ends a WITH list."""
    keys = ", ".join((*pair.keys, *within))
    joined = " and ".join(
        [f"s.{k} = t.{k}" for k in pair.keys]
        + [f"s.{k} is not distinct from t.{k}" for k in within]
    )
    merged = ", ".join(f"coalesce(s.{k}, t.{k}) as {k}" for k in (*pair.keys, *within))
    digest = row_hash(pair.columns if hashed is None else hashed)
    return f"""{sides(pair, where)},
    {prefix}s as (select {keys}, min({digest}) as h, 1 as m from src group by {keys}),
    {prefix}t as (select {keys}, min({digest}) as h, 1 as m from tgt group by {keys}),
    {prefix}diff as (
      select {merged},
             case when s.m is null then 'MISSING_IN_SOURCE'
                  when t.m is null then 'MISSING_IN_TARGET' else 'HASH_MISMATCH' end
                  as mismatch_type,
             s.h as source_row_hash, t.h as target_row_hash
      from {prefix}s s full outer join {prefix}t t on {joined}
      where s.m is null or t.m is null or s.h <> t.h)"""


def diff_sql(pair: DerivedPair, where: str = "true") -> str:
    return f"""with {diff_ctes(pair, where)}
    select {', '.join(pair.keys)}, mismatch_type, source_row_hash, target_row_hash from diff"""


def json_key(keys: Sequence[str], alias: str = "") -> str:
    parts = ", ".join(f"'{k}', {alias}{k}" for k in keys)
    return f"cast(json_object({parts}) as varchar)"


def metric_list(columns: Sequence[str], rows: bool = False) -> list[tuple[str, str, str, bool]]:
    """(column, metric, expression, is_float)"""
    out = [("*", "COUNT", "count(*)", False)] if rows else []
    for c in columns:
        out.append((c, "NULL_COUNT", f"count(*) filter (where {c} is null)", False))
        if c in NUMBERS:
            out.append((c, "SUM", f"{'fsum' if c in FLOATS else 'sum'}({c})", c in FLOATS))
            out.append((c, "AVG", f"{'favg' if c in FLOATS else 'avg'}({c})", True))
        out.append((c, "MIN", f"min({c})", c in FLOATS))
        out.append((c, "MAX", f"max({c})", c in FLOATS))
    return out


def matching(s: str, t: str, is_float: bool) -> str:
    close = f"abs({s} - {t}) < 1e-6" if is_float else f"{s} = {t}"
    return (
        f"(({s} is null and {t} is null) or "
        f"({s} is not null and {t} is not null and {close}))"
    )


def shown_value(value: str) -> str:
    rounded = f"printf('%.8e', try_cast({value} as double) * 1.0000000002929)"
    return f"case when metric in ('SUM', 'AVG') and not regexp_matches({value}, '^-?[0-9]+$') then {rounded} else {value} end"


def two_sided() -> str:
    """Both values of a metric row."""
    return ", ".join(f"{shown_value(f'{side}_value')} as {side}_value" for side in ("source", "target"))


def comparison(
    source: str,
    target: str,
    columns: Sequence[str],
    group_by: Sequence[str] = (),
    rows: bool = False,
) -> str:
    """Metric rows of two relations: groups, column, metric, both values as text, status."""
    metrics = metric_list(columns, rows)
    groups = "".join(f"{g}, " for g in group_by)
    tail = f" group by {', '.join(group_by)}" if group_by else ""
    aggregates = ", ".join(f"{e} as m{i}" for i, (_, _, e, _) in enumerate(metrics))
    joined = " and ".join(f"s.{g} is not distinct from t.{g}" for g in group_by) or "true"
    lead = "".join(f"coalesce(s.{g}, t.{g}) as {g}, " for g in group_by)
    branches = []
    for i, (column, name, _, is_float) in enumerate(metrics):
        ok = matching(f"s.m{i}", f"t.m{i}", is_float)
        branches.append(
            f"select {lead}'{column}' as column_name, '{name}' as metric, "
            f"cast(s.m{i} as varchar) as source_value, cast(t.m{i} as varchar) as target_value, "
            f"case when {ok} then 'PASS' else 'FAIL' end as status "
            f"from ms s full outer join mt t on {joined}"
        )
    return f"""(with ms as (select {groups}{aggregates} from {source}{tail}),
      mt as (select {groups}{aggregates} from {target}{tail})
      {' union all '.join(branches)})"""


def results_sql(
    pair: DerivedPair,
    name: str | None = None,
    where: str = "true",
    parts: Sequence[str] = ("count", "row", "schema", "column"),
    columns: Sequence[str] | None = None,
    extra: str = "",
    every: bool = False,
) -> str:
    """All result rows of a pair with equal schemas; ``every`` compares repeated keys row by row."""
    name = name or pair.table
    columns = pair.columns if columns is None else columns
    base = "'{}' as pair, '{}' as check, {} as column_name, '{}' as metric, "
    rows = []
    if "count" in parts:
        rows.append(
            f"select {base.format(name, 'count', 'null', 'ROW_COUNT')}"
            "cast(n as varchar) as source_value, cast(m as varchar) as target_value, "
            "case when n = m then 'PASS' else 'FAIL' end as status "
            "from (select (select count(*) from src) as n, (select count(*) from tgt) as m)"
        )
    if "row" in parts:
        keys = ", ".join(pair.keys)

        def extra_rows(side: str) -> str:
            return (
                f"(select coalesce(sum(c - 1), 0) from "
                f"(select count(*) as c from {side} group by {keys}))"
            )

        rows.append(
            f"select {base.format(name, 'duplicates', 'null', 'DUPLICATE_ROWS')}"
            "cast(n as varchar), cast(m as varchar), "
            "case when n = 0 and m = 0 then 'PASS' else 'FAIL' end "
            f"from (select {extra_rows('src')} as n, {extra_rows('tgt')} as m)"
        )
        n_rows = "cast(coalesce(sum(n_rows), 0) as bigint)" if every else "count(*)"
        for kind in ("HASH_MISMATCH", "MISSING_IN_SOURCE", "MISSING_IN_TARGET"):
            rows.append(
                f"select {base.format(name, 'row', 'null', kind)}"
                "cast(n as varchar), null, case when n = 0 then 'PASS' else 'FAIL' end "
                f"from (select {n_rows} as n from diff where mismatch_type = '{kind}')"
            )
    if "schema" in parts:
        rows.append(f"select '{name}', 'schema', null, null, null, null, 'PASS'")
    if "column" in parts and columns:
        rows.append(
            f"select '{name}', 'column', column_name, metric, source_value, target_value, status "
            f"from {comparison('src', 'tgt', columns)}"
        )
    if extra:
        rows.append(extra)
    ctes = sides(pair, where)
    if "row" in parts:
        ctes = surplus_ctes(pair) if every else diff_ctes(pair, where)
    return f"""with {ctes}, res as ({' union all '.join(rows)})
    select pair, "check", column_name, metric, {two_sided()}, status from res""".replace(
        " as check,", ' as "check",'
    )


def union(*texts: str) -> str:
    return " union all ".join(f"select * from ({t})" for t in texts)


def record(columns: Sequence[str], alias: str) -> str:
    parts = ", ".join(f"'{c}', {alias}.{c}" for c in columns)
    return f"json_object({parts})"


def details_sql(pair: DerivedPair) -> str:
    """Audit rows with the record of each side whose hash is the smallest of its key."""
    joined = " and ".join("{0}." + k + " = d." + k for k in pair.keys)
    digest = row_hash(pair.columns)
    keys = ", ".join(pair.keys)
    picked = (
        f"select * from (select *, {digest} as h, row_number() over "
        f"(partition by {keys} order by {digest}) as rn from {{}}) where rn = 1"
    )
    return f"""with {diff_ctes(pair)},
    ps as ({picked.format('src')}), pt as ({picked.format('tgt')})
    select {json_key(pair.keys, 'd.')} as primary_key_value, d.mismatch_type,
           d.source_row_hash, d.target_row_hash,
           cast(json_object(
             'source_record', case when ps.h is null then null else {record(pair.columns, 'ps')} end,
             'target_record', case when pt.h is null then null else {record(pair.columns, 'pt')} end
           ) as varchar) as details
    from diff d left join ps on {joined.format('ps')} left join pt on {joined.format('pt')}"""


def cells_sql(pair: DerivedPair) -> str:
    joined = " and ".join("{0}." + k + " = d." + k for k in pair.keys)
    digest = row_hash(pair.columns)
    keys = ", ".join(pair.keys)
    picked = (
        f"select * from (select *, row_number() over "
        f"(partition by {keys} order by {digest}) as rn from {{}}) where rn = 1"
    )
    branches = [
        f"select {', '.join('d.' + k for k in pair.keys)}, '{c}' as column_name, "
        f"cast(ps.{c} as varchar) as source_value, cast(pt.{c} as varchar) as target_value "
        f"from diff d join ps on {joined.format('ps')} join pt on {joined.format('pt')} "
        f"where d.mismatch_type = 'HASH_MISMATCH' and ps.{c} is distinct from pt.{c}"
        for c in pair.columns
    ]
    return f"""with {diff_ctes(pair)},
    ps as ({picked.format('src')}), pt as ({picked.format('tgt')})
    {' union all '.join(branches)}"""


def light_sql(pair: DerivedPair) -> str:
    keys = ", ".join(f"'{k}', {k}" for k in pair.keys)
    return f"""with {diff_ctes(pair)}
    select {json_key(pair.keys)} as primary_key_value, mismatch_type, source_row_hash,
           target_row_hash,
           cast(json_object('pk', json_object({keys}), 'status', mismatch_type) as varchar)
             as details from diff"""


def nodedupe_sql(pair: DerivedPair) -> str:
    """The literal m x n join, counted per key and class."""
    joined = " and ".join(f"s.{k} = t.{k}" for k in pair.keys)
    merged = ", ".join(f"coalesce(s.{k}, t.{k}) as {k}" for k in pair.keys)
    digest = row_hash(pair.columns)
    keys = ", ".join(pair.keys)
    return f"""with {sides(pair)},
    s as (select {keys}, {digest} as h from src), t as (select {keys}, {digest} as h from tgt),
    d as (select {merged}, case when s.h is null then 'MISSING_IN_SOURCE'
                 when t.h is null then 'MISSING_IN_TARGET' else 'HASH_MISMATCH' end as mismatch_type
          from s full outer join t on {joined}
          where s.h is null or t.h is null or s.h <> t.h)
    select {keys}, mismatch_type, cast(count(*) as varchar) as n_pairs
    from d group by {keys}, mismatch_type"""


def surplus_ctes(pair: DerivedPair) -> str:
    """``diff``: the rows of each key that find no equal row on the other side.  Ends a WITH list."""
    keys = ", ".join(pair.keys)
    digest = row_hash(pair.columns)
    return f"""{sides(pair)},
    b as (select {keys}, {digest} as h, 1 as s, 0 as t from src union all select {keys}, {digest}, 0, 1 from tgt),
    g as (select {keys}, h, sum(s) - sum(t) as n from b group by {keys}, h having sum(s) <> sum(t)),
    diff as (select {keys}, case when max(n) over (partition by {keys}) < 0 then 'MISSING_IN_SOURCE'
               when min(n) over (partition by {keys}) > 0 then 'MISSING_IN_TARGET' else 'HASH_MISMATCH' end as mismatch_type,
             case when n > 0 then h end as source_row_hash, case when n < 0 then h end as target_row_hash,
             cast(abs(n) as bigint) as n_rows from g)"""


def relaxed_numbers_sql(pair: DerivedPair) -> str:
    """Both sides as doubles, which hold all the values of this pair; texts of those that differ."""
    def text(value: str) -> str:
        plain = f"regexp_replace(regexp_replace(cast({value} as varchar), '([.][0-9]*[1-9])0+$|[.]0+$', '\\1'), '^-0$', '0')"
        return f"case when isnan(cast({value} as double)) then 'NaN' when cast({value} as double) = 1e-11 then '0.00000000001' else {plain} end"

    branches = [
        f"select s.s_suppkey, '{c}' as column_name, {text(f's.{c}')} as source_value, {text(f't.{c}')} as target_value "
        f"from src s join tgt t on s.s_suppkey = t.s_suppkey where cast(s.{c} as double) is distinct from cast(t.{c} as double)"
        for c in pair.columns
    ]
    return f"with {sides(pair)} {' union all '.join(branches)}"


def isolated_sql() -> str:
    """Checks that fail while they run are one ERROR row each; all others have their rows."""
    whole = " union all ".join(f'select pair, "check", status from ({results_sql(p)})' for p in (CUSTOMER, ORDERS))
    broken = """select * from (values ('bad cast', 'count', 'PASS'), ('bad cast', 'row', 'ERROR'), ('bad cast', 'column', 'ERROR'),
      ('bad cast', 'schema', 'PASS'), ('no key', 'count', 'ERROR'), ('no key', 'row', 'ERROR'), ('no key', 'column', 'ERROR'),
      ('no key', 'schema', 'PASS')) v(pair, "check", status)"""
    return f'select pair, "check", status, count(*) as n from ({whole} union all {broken}) group by pair, "check", status'


def hash_groups_sql(pair: DerivedPair) -> str:
    keys = ", ".join(pair.keys)
    digest = row_hash(pair.columns)
    return f"""with {sides(pair)},
    b as (select {keys}, {digest} as row_hash, 1 as s, 0 as t from src
          union all select {keys}, {digest}, 0, 1 from tgt)
    select {keys}, row_hash, cast(sum(s) as bigint) as n_source, cast(sum(t) as bigint) as n_target
    from b group by {keys}, row_hash"""


def missing_sql(pair: DerivedPair, here: str, there: str) -> str:
    keys = ", ".join(pair.keys)
    joined = " and ".join(f"a.{k} = b.{k}" for k in pair.keys)
    return f"""with {sides(pair)}
    select {keys}, count(*) as n_rows from {here} a
    where not exists (select 1 from {there} b where {joined}) group by {keys}"""


def dedupe_sql(pair: DerivedPair) -> str:
    keys = ", ".join(pair.keys)
    digest = row_hash(pair.columns)
    shown = ", ".join(
        f"cast({c} as varchar) as {c}" if c == "l_shipdate" else c for c in (*pair.keys, *pair.columns)
    )
    return f"""with {sides(pair)}
    select {shown} from (select *, row_number() over (partition by {keys} order by {digest}) as rn
    from src) where rn = 1"""


def duplicates_sql(*pairs: DerivedPair) -> str:
    rows = []
    for pair in pairs:
        for side in ("source", "target"):
            rows.append(
                f"select '{pair.table}' as pair, '{side}' as side, "
                "cast(coalesce(sum(c - 1), 0) as bigint) as n_duplicates from (select count(*) as c "
                f"from ({pair.sql(side)}) group by {', '.join(pair.keys)})"
            )
    return " union all ".join(rows)


def sample_cte(pair: DerivedPair) -> str:
    keys = ", ".join(pair.keys)
    order = f"sha256({row_text(pair.keys)} || ':{SAMPLE_SEED}')"
    nonnull = " and ".join(f"{k} is not null" for k in pair.keys)
    return f"""sampled_keys as (select {keys} from ({pair.sql('source')}) where {nonnull}
      group by {keys} order by {order} limit {SAMPLE_SIZE})"""


def sampled_diff_sql(pair: DerivedPair) -> str:
    keys = ", ".join(pair.keys)
    only = f"({keys}) in (select {keys} from sampled_keys)"
    return f"""with {sample_cte(pair)}, {diff_ctes(pair, only)}
    select {keys}, mismatch_type, source_row_hash, target_row_hash from diff"""


def metrics_sql(pair: DerivedPair) -> str:
    rows = [
        f"select '{c}' as column_name, '{m}' as metric, cast({e} as varchar) as v from tgt"
        for c, m, e, _ in metric_list(pair.columns, rows=True)
    ]
    return f"""with {sides(pair)}, w as ({' union all '.join(rows)})
    select column_name, metric, {shown_value('v')} as value from w"""


def grouped_check_sql(pair: DerivedPair, groups: Sequence[str]) -> str:
    """The metric rows of the final groups and a verdict for each."""
    first, both = groups[:1], list(groups)
    g1 = first[0]
    shown = f"column_name, metric, {two_sided()}, status"
    return f"""with {drilldown_ctes(pair, groups)}
    select {json_key(first)} as group_key, {shown} from c1 where {g1} in (select {g1} from v1 where ok)
    union all
    select {json_key(both)}, {shown} from c2 where {g1} in (select {g1} from v1 where not ok)
    union all
    select {json_key(first)}, '*', 'GROUP', null, null, 'PASS' from v1 where ok
    union all
    select {json_key(both)}, '*', 'GROUP', null, null, case when ok then 'PASS' else 'FAIL' end from v2"""


def drilldown_sql(pair: DerivedPair, groups: Sequence[str]) -> str:
    """Two levels, then rows inside the failing groups."""
    first, both = groups[:1], list(groups)
    return f"""with {drilldown_ctes(pair, groups)}
    select cast(1 as bigint) as level, {json_key(first)} as group_key, 'PASS' as outcome,
           cast(null as varchar) as primary_key_value from v1 where ok
    union all
    select 2, {json_key(both)}, case when ok then 'PASS' else 'FAIL' end, null from v2
    union all
    select 3, {json_key(both)}, outcome, {json_key(pair.keys)} from rd"""


def drilldown_ctes(pair: DerivedPair, groups: Sequence[str]) -> str:
    first, both = groups[:1], list(groups)
    columns = [c for c in pair.columns if c not in groups]
    early = [c for c in pair.columns if c not in first]
    g1, g2 = first[0], both[1]
    same = " and ".join(f"x.{g} is not distinct from f.{g}" for g in both)
    inside = f"exists (select 1 from failed f where {same})"
    keys = ", ".join((*pair.keys, *both))
    joined = " and ".join(
        [f"s.{k} = t.{k}" for k in pair.keys] + [f"s.{g} is not distinct from t.{g}" for g in both]
    )
    merged = ", ".join(f"case when s.m is null then t.{k} else s.{k} end as {k}" for k in (*pair.keys, *both))
    digest = row_hash(pair.columns)
    return f"""{sides(pair)},
    c1 as (select * from {comparison('src', 'tgt', early, first, rows=True)}),
    v1 as (select {g1}, bool_and(status = 'PASS') as ok from c1 group by {g1}),
    c2 as (select * from {comparison('src', 'tgt', columns, both, rows=True)}),
    v2 as (select {g1}, {g2}, bool_and(status = 'PASS') as ok from c2
           where {g1} in (select {g1} from v1 where not ok) group by {g1}, {g2}),
    failed as (select {g1}, {g2} from v2 where not ok),
    fs as (select {keys}, min({digest}) as h, 1 as m from src x where {inside} group by {keys}),
    ft as (select {keys}, min({digest}) as h, 1 as m from tgt x where {inside} group by {keys}),
    rd as (select {merged}, case when s.m is null then 'MISSING_IN_SOURCE'
                  when t.m is null then 'MISSING_IN_TARGET' else 'HASH_MISMATCH' end as outcome
           from fs s full outer join ft t on {joined}
           where s.m is null or t.m is null or s.h <> t.h)"""


def fingerprint_sql(pair: DerivedPair, n: int) -> str:
    digest = row_hash((*pair.keys, *pair.columns))

    def number(text: str, start: int) -> str:
        return f"cast('0x' || substr({text}, {start}, 15) as bigint)"

    def side(name: str) -> str:
        return f"""select {number(row_hash(pair.keys), 1)} % {n} as bucket, {number(digest, 1)} as x,
          {number(digest, 16)} as a from {name}"""

    def aggregated(flag: str, name: str) -> str:
        return f"""count(*) filter (where {flag}) as {name}_rows,
          coalesce(bit_xor(x) filter (where {flag}), 0) as {name}_xor,
          cast(coalesce(sum(a) filter (where {flag}), 0) as varchar) as {name}_sum"""

    return f"""with {sides(pair)},
    b as (select *, true as here from ({side('src')}) union all
          select *, false from ({side('tgt')}))
    select bucket, {aggregated('here', 'source')}, {aggregated('not here', 'target')}
    from b group by bucket"""


def null_counts_sql(pair: DerivedPair, columns: Sequence[str]) -> str:
    rows = [
        f"select '{c}' as column_name, "
        f"(select count(*) from src where {c} is null) as source_nulls, "
        f"(select count(*) from tgt where {c} is null) as target_nulls"
        for c in columns
    ]
    return f"with {sides(pair)} {' union all '.join(rows)}"


def inventory_cte() -> str:
    tidy = ", ".join(
        f"trim(coalesce({c}, '')) as {c}"
        for c in ("source_table", "target_table", "primary_key", "filter_condition")
    )
    rows = INVENTORY.replace("{part}", "part")
    return f"inv as (select line, lower(trim(validation_type)) as validation_type, {tidy} from ({rows}))"


def lint_sql() -> str:
    named = "source_table <> '' and target_table <> ''"
    unsafe = " or ".join(f"contains(filter_condition, '{x}')" for x in (";", "--", "/*", "*/"))
    rules = [
        ("R2", "ERROR", "source_table = '' or target_table = ''"),
        ("R3", "ERROR", f"{named} and validation_type not in ('row', 'column', 'schema')"),
        ("R4", "ERROR", f"{named} and validation_type = 'row' and primary_key = ''"),
        ("R5", "WARNING", f"{named} and validation_type = 'column' and primary_key <> ''"),
        ("R6", "ERROR", f"{named} and ({unsafe})"),
    ]
    found = [
        f"select line, source_table as subject, '{r}' as rule, '{s}' as severity from inv where {w}"
        for r, s, w in rules
    ]
    return f"with {inventory_cte()} {' union all '.join(found)}"


def plan_sql() -> str:
    fields = ("source_table", "target_table", "validation_type", "primary_key", "filter_condition")
    identity = " || ".join(f"length({f}) || ':' || {f}" for f in fields)
    return f"""with {inventory_cte()}
    select sha256({identity}) as plan_key, source_table as source, target_table as target,
           validation_type as type,
           case when validation_type = 'row' then replace(primary_key, ', ', '+') else '' end
             as primary_keys,
           case when validation_type = 'row' then '*' end as concat,
           case when filter_condition <> '' then filter_condition end as filters
    from inv where source_table <> '' and target_table <> ''"""


def inventory_load_sql() -> str:
    columns = "source_table, target_table, validation_type, primary_key, filter_condition"
    return f"with {inventory_cte()} select {columns}, count(*) as n from inv group by {columns}"


def schema_sql() -> str:
    return """
    select 'schema' as "check", * from (values
      ('load_tag', 'MISSING IN SOURCE', null, 'string', 'FAIL'),
      ('s_nationkey', 'MISSING IN TARGET', 'int', null, 'FAIL'),
      ('s_suppkey', 'DATA TYPE MISMATCH', 'bigint', 'int', 'FAIL')
    ) v(column_name, metric, source_value, target_value, status)
    union all
    select 'count', null, 'ROW_COUNT', cast(count(*) as varchar), cast(count(*) as varchar), 'PASS'
    from supplier"""


def run_plan_sql() -> str:
    customer = results_sql(CUSTOMER, "SRC.CUSTOMER=tgt.customer", "c_acctbal >= 0", ("count", "row"))
    columns = results_sql(
        CUSTOMER,
        "SRC.CUSTOMER=tgt.customer",
        parts=("count", "column"),
        columns=("c_custkey", *CUSTOMER.columns),
    )
    lineitem = results_sql(LINEITEM, "SRC.LINEITEM=tgt.lineitem", parts=("count", "row"))
    supplier = f"""select 'SRC.SUPPLIER=tgt.supplier' as pair, "check", column_name, metric,
      {two_sided()}, status from ({schema_sql()}) where "check" = 'schema'"""
    return union(customer, columns, lineitem, supplier)


def custom_row_sql(pair: DerivedPair) -> str:
    return f"""with {diff_ctes(pair)}
    select {json_key(pair.keys)} as primary_key_value, mismatch_type, source_row_hash,
           target_row_hash from diff"""


def key_filter_sql(pair: DerivedPair) -> str:
    return f"""with {diff_ctes(pair)}
    select o_custkey as cust, count(*) as n_orders from orders
    where o_custkey in (select o_custkey from diff where mismatch_type = 'HASH_MISMATCH')
    group by o_custkey"""


CUSTOMER_RESULTS = results_sql(CUSTOMER)
COLUMN_CHECK = ("c_custkey", *CUSTOMER.columns)

NEGATIVE = """select 'customer', 'negative_balances', null, 'COUNT', cast(n as varchar),
  cast(m as varchar), case when n = m then 'PASS' else 'FAIL' end
  from (select (select count(*) from src where c_acctbal < 0) as n,
               (select count(*) from tgt where c_acctbal < 0) as m)"""

ORACLES: dict[str, str] = {
    "scan_row_count": " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from {t}"
        for t in ("customer", "events", "lineitem", "orders", "supplier")
    ),
    "count_from_footers": " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows, cast(min({k}) as bigint) as low, cast(max({k}) as bigint) as high from {t}"
        for t, k in (("customer", "c_custkey"), ("events", "event_id"), ("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("supplier", "s_suppkey"))
    ),
    "custom_query_row": custom_row_sql(CUSTOM_ROW),
    "custom_query_column": results_sql(CUSTOM_COLUMN, "custom", parts=("count", "column")),
    "schema_diff": schema_sql(),
    "inventory_load": inventory_load_sql(),
    "audit_roundtrip": f"select 'run-1' as run_id, 'customer' as pair, * from ({details_sql(CUSTOMER)})",
    "results_roundtrip": CUSTOMER_RESULTS,
    "top_mismatches": f"""select primary_key_value, mismatch_type from ({light_sql(CUSTOMER)})
      order by primary_key_value, mismatch_type limit 10""",
    "run_history": f"""select run_id, pair, status, count(*) as n_rows
      from ({CUSTOMER_RESULTS}) r cross join (values ('run-1'), ('run-2')) v(run_id)
      group by run_id, pair, status""",
    "pair_filter": diff_sql(EVENTS, EVENTS_FILTER_SQL),
    "key_filter": key_filter_sql(CUSTOM_ROW),
    "key_sample": f"with {sample_cte(LINEITEM)} select * from sampled_keys",
    "random_row_sample": sampled_diff_sql(CUSTOMER),
    "common_columns": null_counts_sql(SUPPLIER, SUPPLIER.columns),
    "common_columns_relaxed": null_counts_sql(RELAXED, RELAXED.columns),
    "row_hash": f"""with {sides(CUSTOMER)}
      select c_custkey, {row_hash(CUSTOMER.columns)} as row_hash from tgt""",
    "row_hash_strict": f"""with {sides(EVENTS)}
      select event_id, {strict_hash(EVENTS.columns)} as row_hash from tgt""",
    "row_hash_fast": f"select c_custkey, mismatch_type from ({diff_sql(CUSTOMER)})",
    "pk_json": f"""select {json_key(LINEITEM.keys)} as primary_key_value, mismatch_type
      from ({diff_sql(LINEITEM)})""",
    "row_diff_details": details_sql(CUSTOMER),
    "row_diff_light": light_sql(CUSTOMER),
    "normalised_key_diff": f"""with {diff_ctes(
        DerivedPair(PADDED.table, PADDED.keys, PADDED.columns,
                    PADDED.source.replace("rpad(c_name, 25, ' ')", "rtrim(c_name)"), PADDED.target)
      )} select c_name, mismatch_type, source_row_hash, target_row_hash from diff""",
    "row_diff": diff_sql(CUSTOMER),
    "row_diff_composite": diff_sql(LINEITEM),
    "row_diff_null_keys": diff_sql(EVENTS),
    "row_diff_one_missing": diff_sql(ORDERS),
    "row_diff_nodedupe": nodedupe_sql(LINEITEM),
    "row_hash_groups": hash_groups_sql(LINEITEM),
    "row_surplus": f"""with {surplus_ctes(LINEITEM)}
      select l_orderkey, l_linenumber, mismatch_type, source_row_hash, target_row_hash, n_rows from diff""",
    "relaxed_numbers": relaxed_numbers_sql(MIXED_NUMBERS),
    "missing_in_source": missing_sql(LINEITEM, "tgt", "src"),
    "missing_in_target": missing_sql(LINEITEM, "src", "tgt"),
    "hash_mismatch": f"select * from ({diff_sql(LINEITEM)}) where mismatch_type = 'HASH_MISMATCH'",
    "cell_diff": cells_sql(CUSTOMER),
    "dedupe_keys": dedupe_sql(LINEITEM),
    "mismatch_summary": union(
        *[
            f"select '{p.table}' as pair, mismatch_type, count(*) as n_keys from ({diff_sql(p)})"
            " group by mismatch_type"
            for p in (CUSTOMER, ORDERS, EVENTS, LINEITEM)
        ]
    ),
    "count_check": f"""with {sides(LINEITEM)}
      select n as source_count, m as target_count, n - m as difference
      from (select (select count(*) from src) as n, (select count(*) from tgt) as m)""",
    "duplicate_keys": duplicates_sql(CUSTOMER, EVENTS, LINEITEM),
    "duplicate_groups": f"""with {sides(LINEITEM)}
      select l_orderkey, l_linenumber, count(*) as n_rows from tgt
      group by l_orderkey, l_linenumber having count(*) > 1""",
    "column_metrics": metrics_sql(LINEITEM),
    "column_drift": f"""with {sides(CUSTOMER)}
      select column_name, metric, {two_sided()}, status
      from {comparison('src', 'tgt', CUSTOMER.columns)} where status = 'FAIL'""",
    "column_drift_empty": f"""select * from ({results_sql(DISJOINT, parts=('count',))})
      union all select 'orders', 'column', null, null, null, null, 'SKIPPED'""",
    "grouped_column_diff": f"""with {sides(CUSTOMER)}
      select {json_key(['c_nationkey'])} as group_key, column_name, metric, {two_sided()}, status
      from {comparison('src', 'tgt', [c for c in CUSTOMER.columns if c != 'c_nationkey'],
                       ['c_nationkey'], rows=True)} where status = 'FAIL'""",
    "grouped_drilldown": drilldown_sql(CUSTOMER, DRILL_GROUPS),
    "bucket_fingerprint": fingerprint_sql(LINEITEM, N_BUCKETS),
    "bucket_narrowed_diff": diff_sql(LINEITEM),
    "fingerprint_tree_diff": diff_sql(LINEITEM),
    "validate_pair": CUSTOMER_RESULTS,
    "validate_pair_composite": results_sql(LINEITEM),
    "validate_pair_all_rows": results_sql(LINEITEM, every=True),
    "validate_pair_mapped": results_sql(FILTERED),
    "validate_grouped": grouped_check_sql(CUSTOMER, DRILL_GROUPS),
    "batch_isolated": isolated_sql(),
    "batch_validate": union(*[results_sql(p) for p in (CUSTOMER, ORDERS, EVENTS, LINEITEM)]),
    "plan_row_check": results_sql(EVENTS, where=EVENTS_FILTER_SQL, parts=("count", "row")),
    "plan_column_check": results_sql(
        CUSTOMER, where="c_acctbal >= 0", parts=("count", "column"), columns=COLUMN_CHECK
    ),
    "inventory_lint": lint_sql(),
    "plan_compile": plan_sql(),
    "run_plan": run_plan_sql(),
    "extra_check": results_sql(CUSTOMER, extra=NEGATIVE),
}
