"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from catalogue_evidence.llm import decontaminate as d
from catalogue_evidence.llm import licences as c


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _words(table: str, key: str) -> str:
    return f"select {key}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') w from {table} where text is not null"


def _grams(n: str) -> str:
    return f"list_transform(range(1, greatest(len(w) - {n} + 2, 2)), lambda i: array_to_string(w[i:i + {n} - 1], ' '))"


def op4() -> str:
    return f"""with b as ({_words('benchmark', 'item_id')}), t as ({_words('documents', 'doc_id')}),
      i as (select distinct item_id, unnest({_grams(str(d.WORDS))}) s from b where len(w) > 0), k as (select item_id, count(*) n_shingles from i group by 1),
      short as (select distinct len(w) n from b where len(w) between 1 and {d.WORDS - 1}),
      x as (select distinct doc_id, unnest({_grams(str(d.WORDS))}) s from t where len(w) > 0 union select doc_id, unnest({_grams('n')}) from t, short where len(w) >= n),
      f as (select doc_id, item_id, count(*) n_found from x join i using (s) group by 1, 2)
      select doc_id, item_id, n_shingles, n_found, n_found::double / n_shingles containment from f join k using (item_id) where n_found >= {d.THRESHOLD} * n_shingles - 1e-9"""


def _canonical(x: str) -> str:
    t = f"regexp_replace(lower({x}), {_q(c.STATEMENT)}, '\\1', 'g')"
    for gone in (c.RESERVED, c.COPYRIGHT):
        t = f"regexp_replace({t}, {_q(gone)}, '', 'g')"
    t = f"regexp_replace(' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' ', '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g')"
    for was, now in c.EQUIVALENT:
        t = f"replace({t}, {_q(f' {was.replace(chr(32), chr(32) * 2)} ')}, {_q(f' {now.replace(chr(32), chr(32) * 2)} ')})"
    return f"list_filter(list_transform(string_split({t}, chr(10)), lambda l: trim(replace(l, '  ', ' '))), lambda l: l <> '')"


def op8() -> str:
    known = ", ".join(f"({_q(a)}, {_q(b)}, {_q(t)})" for a, b, t in c.KNOWN)
    return f"""with k as (select license_id, min(kind) kind, u from (select license_id, kind, array_to_string({_canonical('t')}, ' ') u from (values {known}) v(license_id, kind, t)) group by license_id, u),
      d as (select doc_id, {_canonical('text')} ls from documents where text is not null),
      u as (select doc_id, 'line' "scope", unnest(ls) u from d union all select doc_id, 'text', array_to_string(ls, ' ') from d)
      select doc_id, license_id, kind, "scope", count(*) n from u join k using (u) where u <> '' group by all"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": op4(), "op8_licences": op8()}
