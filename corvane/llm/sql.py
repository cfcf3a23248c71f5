"""DuckDB SQL of the corpus queries that SQL can express: op1, op2, op9 and op10. The others train a larger model, draw or search."""

from __future__ import annotations

from corvane.llm import urls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = UPPER + "234567"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Five hexadecimal digits of a SHA-1 are 20 bits, so four letters.
ARCHIVE = f"""with p as (select page_id, url, coalesce(html, '') payload from pages),
d as (select page_id, url, payload, sha1(payload) hex from p),
b as (select page_id, url, strlen(payload)::bigint payload_bytes, hex, list_aggregate(list_transform(range(0, 32), lambda i: substr('{BASE32}', ((('0x' || substr(hex, (i // 4 * 5 + 1)::bigint, 5))::bigint >> (15 - i % 4 * 5)::bigint) & 31) + 1, 1)), 'string_agg', '') payload_digest from d),
r as (select hex, max(page_id) response from d group by 1)
select page_id, url url, payload_bytes, payload_digest, true intact, case when page_id = response then 'response' else 'revisit' end record_type, case when page_id <> response then response end refers_to from b join r using (hex)"""

NEAR = f"""with recursive w as (select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} w from documents),
s as (select distinct doc_id, md5_number(sh) sh from (select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) sh from w)),
n as (select doc_id, count(*) n from s group by 1),
p as (select x.doc_id a, y.doc_id b, count(*) c from s x join s y using (sh) where x.doc_id < y.doc_id group by all),
l as (select a, b from p join n u on u.doc_id = a join n v on v.doc_id = b where 100 * c >= 75 * (u.n + v.n - c)),
e as (select a, b from l union all select b, a from l),
r(x, y) as (select doc_id, doc_id from w union select r.x, e.b from r join e on r.y = e.a),
c as (select x doc_id, min(y) component_id from r group by 1)
select doc_id, coalesce(n, 0)::bigint n_shingles, component_id, doc_id = component_id kept from c left join n using (doc_id)"""

REPEATS = f"""with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} w from documents),
i as (select doc_id, unnest(range(1, len(w) - 18)) i, unnest(list_transform(range(1, len(w) - 18), lambda i: md5_number(array_to_string(w[i:i + 19], ' ')))) h from w where len(w) >= 20),
again as (select doc_id, i from (select doc_id, i, row_number() over (partition by h order by doc_id, i) r from i) where r > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) pos from again),
o as (select doc_id, unnest(range(1, len(w) + 1)) pos, unnest(w) word from w),
k as (select doc_id, string_agg(word, ' ' order by pos) kept, count(*) n from o anti join gone using (doc_id, pos) group by 1)
select doc_id, len(w)::bigint n_words, (len(w) - coalesce(n, 0))::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from w left join k using (doc_id)"""


def _cut(rows: str) -> str:
    """Columns host and path of a table with url."""
    rest = "case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end"
    return f"select *, translate(regexp_extract(coalesce({rest}, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') host, regexp_extract(coalesce({rest}, ''), '^[^/?#]*([^?#]*)', 1) path from {rows}"


def _grams(rows: str) -> str:
    """Distinct (row, i) of a table with row, host and path."""
    cut = [f"list_transform(range(1, greatest(0, length({c}) + 2 - {n} + 1) + 1), lambda j: '{c[0]}' || substr('^' || {c} || '$', j, {n}))" for c in ("host", "path") for n in urls.GRAMS]
    return f"select distinct row, ('0x' || md5(x)[1:4])::int % {urls.DIM} i from (select row, unnest(flatten([{', '.join(cut)}])) x from {rows})"


def _rules() -> str:
    out = {"name": "null", "verdict": "null"}
    for h, p, v in sorted(urls.RULES, key=lambda r: (len(r[0]) + len(r[1]), r)):
        for k, x in (("name", h + p), ("verdict", v)):
            out[k] = f"case when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{x}' else {out[k]} end"
    return f'{out["name"]} as "rule", {out["verdict"]} ruled'


def _filter() -> str:
    """The rules, the training of the model step by step, and its scores."""
    n, wide = len(urls.labelled_rows()), urls.DIM
    parts = [
        f"l(url, y, row) as (values {', '.join(f"('{u}', {y}, {k})" for k, (u, y) in enumerate(urls.labelled_rows()))})",
        f"t as ({_cut('l')})",
        f"g as materialized ({_grams('t')})",
        "z as materialized (select row, any_value(y) y, sqrt(greatest(count(i), 1)) k from l left join g using (row) group by row)",
        f"w0 as (select unnest(range({wide + 1})) i, 0.0::double w, 0.0::double v)",
    ]
    for k in range(urls.STEPS):
        parts += [
            f"m{k} as materialized (select row, any_value(z.k) k, 1 / (1 + exp(-(sum(coalesce(w, 0)) / any_value(z.k) + (select w from w{k} where i = {wide})))) - any_value(y) m from z left join g using (row) left join w{k} using (i) group by row)",
            f"s{k} as (select i, sum(m / k) s from g join m{k} using (row) group by i union all select {wide}, sum(m) from m{k})",
            f"v{k} as (select i, w, {urls.KEEP} * v - {urls.RATE} * (coalesce(s, 0) / {n}.0 + {urls.DECAY} * w) v from w{k} left join s{k} using (i))",
            f"w{k + 1} as materialized (select i, round(w + v, 9) w, v from v{k})",
        ]
    last = f"w{urls.STEPS}"
    parts += [
        f"p as materialized ({_cut('(select page_id, url, row_number() over () row from pages)')})",
        f"q as ({_grams('p')})",
        f"c as (select row, round(1 / (1 + exp(-(sum({last}.w) / sqrt(greatest(count(*), 1)) + (select w from {last} where i = {wide})))), 6) score from q join {last} using (i) group by row)",
        f"o as (select row, round(1 / (1 + exp(-w)), 6) score from p, {last} where i = {wide})",
        f"r as (select row, page_id, host, path, {_rules()} from p)",
    ]
    return "with " + ",\n".join(parts) + """
select page_id, host, path, "rule", coalesce(ruled, case when coalesce(c.score, o.score) >= 0.5 then 'block' else 'allow' end) verdict, coalesce(c.score, o.score) score from r left join c using (row) left join o using (row)"""


URLS = _filter()
