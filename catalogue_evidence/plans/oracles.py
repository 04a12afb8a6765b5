"""DuckDB SQL for the library's queries, put together from the same derived tables as in adapters."""

from __future__ import annotations

from catalogue_evidence.functions import text as t
from catalogue_evidence.functions import urls as u
from catalogue_evidence.operators import audit, publish, scoring
from catalogue_evidence.operators import review as r
from catalogue_evidence.operators.conflicts import CONFLICT, REASON


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def texts(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


#: Character references that the test tables hold at most; the ampersand's comes last, so that nothing is resolved twice.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&trade;": "™", "&reg;": "®", "&amp;": "&"}
#: References as texts hold them, and what they stand for; the first are those of b1_references, by part number.
REFERENCES = {
    "&eacute;": "é", "&#233;": "é", "&#xE9": "é", "&notit;": "¬it;", "&frac12;": "½", "&amp;amp;": "&amp;", "&#53;0": "50", "&unknown;": "&unknown;", "&#x38;&#x30": "80", "&rarr;": "→",
    "& 3": "& 3", "&#128;": "€", "&Tab;": "\t", "&copy5": "©5", "&#0;": "\ufffd", "&lt;b&gt": "<b>", "&#9999999999;": "\ufffd", "&;": "&;", "&#11;": "", "&ampx": "&x",
}


def norm(x: str) -> str:
    x = f"coalesce({x}, '')"
    for was, now in ENTITIES.items():
        x = f"replace({x}, {q(was)}, {q(now)})"
    x = f"translate(lower({x}), '™®', '  ')"
    for was, now in t.UNIT_ALIASES.items():
        x = f"replace({x}, {q(was)}, {q(now)})"
    return f"trim(regexp_replace({x}, '[^a-z0-9.]+', ' ', 'g'))"


def norm_plain(x: str) -> str:
    """norm() of a text whose references are resolved already."""
    x = f"translate(lower({x}), '™®', '  ')"
    for was, now in t.UNIT_ALIASES.items():
        x = f"replace({x}, {q(was)}, {q(now)})"
    return f"trim(regexp_replace({x}, '[^a-z0-9.]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(regexp_extract_all({norm(x)}, '[a-z0-9]+'), lambda w: length(w) > 1 and not list_contains({texts(t.STOPWORDS)}, w))"


def sizes(x: str) -> str:
    n = norm(x)
    found = ", ".join(f"regexp_extract_all({n}, {q(p)})" for p in t.SIZE_PATTERNS)
    plain = f"list_transform(flatten([{found}]), lambda w: regexp_replace(w, '\\s+', '', 'g'))"
    same = " ".join(f"when {q(a)} then {q(b)}" for a, b in t.EQUIVALENT_SIZES.items())
    more = f"list_filter(list_transform({plain}, lambda w: case w {same} end), lambda w: w is not null)"
    return f"list_distinct(list_concat({plain}, {more}))"


def cover(need: str, hay: str) -> str:
    return f"case when len({need}) = 0 then 1.0::double else len(list_filter({need}, lambda w: list_contains({hay}, w)))::double / greatest(len({need}), 1) end"


def fits(want: str, have: str) -> str:
    return f"(len({want}) = 0 or list_has_any({want}, {have}))"


def domain(x: str) -> str:
    return f"regexp_replace(regexp_extract(lower({x}), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1), '^www\\.', '')"


def unquote(x: str) -> str:
    return f"url_decode(replace({x}, '+', '%2B'))"


def bad(x: str) -> str:
    return f"regexp_matches(lower({unquote(x)}), {q('|'.join([*u.BAD_URL_WORDS, *u.SITE_DEFAULTS]))})"


def direct(x: str) -> str:
    return f"regexp_matches({x}, {q(u.IMAGE_EXTENSION)})"


REGION = "['ca','eu','uk','us'][p_partkey % 4 + 1]"
PKEY = f"concat({REGION}, ':p', p_partkey, ':0')"
STAGED = "starts_with(status, 'STAGED')"
CATALOGUE = f"""
cat as (select cast(p_partkey + 1 as varchar) "batchIndex", p_partkey n, {REGION} region, {PKEY} "immutableKey", concat('p', p_partkey) "productId",
  '0' "variantIndex", p_brand brand, p_name "productName", concat(p_size, [' caps',' ml',' softgel',' g'][p_partkey // 4 % 4 + 1]) size,
  concat('https://shop', p_partkey % 37, '.example.com/', case when p_partkey % 11 = 0 then 'shared' else p_partkey::varchar end) "sourcePage",
  concat('supplier', p_partkey % 7, '.example.com') "sourceDomain",
  case p_partkey % 5 when 0 then 'official-manufacturer-product-page' when 1 then 'barcode-database' else 'third-party-product-page' end "sourceClass",
  concat('https://img.example.com/', p_partkey % 900, case when p_partkey % 3 = 0 then '.jpg' else '' end) "currentImageReference",
  p_partkey % 11 = 0 shared, p_partkey % 5 = 1 barcode, left(md5({PKEY}), 24) "assetId",
  concat('assets/product-images/catalogue-v28/', left(md5({PKEY}), 24), '.jpg') "targetJpgPath" from part)"""
DOMAINS = f"""
dom as (select distinct p_brand brand, concat('supplier', l_suppkey % 7, '.example.com') d from lineitem join part on l_partkey = p_partkey where l_suppkey % 3 = 0),
doms as (select {norm('brand')} nb, list(distinct lower(d)) ds from dom group by 1),
catd as (select c.*, list_sort(list_distinct(list_concat(coalesce(ds, []::varchar[]),
  case when "sourceClass" = 'official-manufacturer-product-page' then [lower("sourceDomain")] else []::varchar[] end))) domains
  from cat c left join doms on {norm('c.brand')} = nb)"""
CANDIDATES = f"""
cand as (select *, row_number() over (partition by "immutableKey" order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) disc_ord from (
  select {PKEY} "immutableKey", concat('https://www.supplier', l_suppkey % 7, '.example.com/', case l_linenumber % 3 when 0 then replace(p_name, ' ', '-')
    when 1 then concat(lower(p_brand), '-', replace(p_name, ' ', '%20')) else 'item' end, '-', p_size, ['-caps','-ml','-softgel','-g'][p_partkey // 4 % 4 + 1], '-', l_suppkey,
    case when l_linenumber % 6 = 5 then '-logo' else '' end, '.jpg') url,
  concat('https://www.supplier', l_suppkey % 7, '.example.com/p', l_partkey, case when l_linenumber % 5 = 4 then '?attribute_size=1' else '' end) page_url,
  ['jsonld-product-image','shopify-product-json','woocommerce-gallery','og-image','twitter-image','page-img','rss'][l_linenumber % 7 + 1] origin,
  case when l_linenumber % 2 = 0 then concat(p_brand, ' ', p_name) else p_type end alt, p_name page_title,
  case when l_linenumber % 7 = 0 then p_name else '' end spn, case when l_linenumber % 7 < 2 then p_brand else '' end sbr,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate from lineitem join part on l_partkey = p_partkey))"""
_dec = unquote("url")
def scored(source: str) -> str:
    return f"""
seen as (select *, {tokens(f"concat_ws(' ', spn, sbr, alt, page_title, {_dec})")} ident, {sizes(f"concat_ws(' ', spn, sbr, alt, {_dec})")} imgs,
  {tokens(f"concat_ws(' ', {_dec}, alt)")} uat, {sizes(f"concat_ws(' ', {_dec}, alt)")} uas, {tokens(_dec)} urlt,
  {tokens("concat_ws(' ', url, alt, spn)")} lvt, {tokens("concat_ws(' ', sbr, url, alt, spn)")} lvb, {sizes("concat_ws(' ', url, alt, spn)")} lvs, {domain('page_url')} pdom, {bad('url')} isbad from {source}),
want as (select "immutableKey" k, domains, {tokens('brand')} bt, {tokens('"productName"')} pt, {sizes('size')} ss from catd),
fig as (select s.*, {cover('bt', 'ident')} brand_cov, {cover('pt', 'ident')} product_cov, {fits('ss', 'imgs')} size_ok, {cover('pt', 'uat')} near, {fits('ss', 'uas')} near_size,
  len(list_filter(domains, lambda d: ends_with(pdom, d))) > 0 loose,
  {cover('pt', 'urlt')} url_product_cov, {cover('bt', 'urlt')} url_brand_cov, {cover('pt', 'lvt')} level_product_cov, {cover('bt', 'lvb')} level_brand_cov, {fits('ss', 'lvs')} level_size_ok from seen s join want on k = "immutableKey"),
exa as (select *, brand_cov >= 0.5 and product_cov >= 0.82 and size_ok exact from fig),
scored as (select *, (case origin {' '.join(f"when {q(k)} then {v}" for k, v in scoring.ORIGINS.items())} else {scoring.OTHER} end
  + (brand_cov * 20 + product_cov * 45) + case when size_ok then 25 else -25 end + case when exact then 15 else -10 end + near * 18
  + case when near_size then 12 else 0 end + case when loose then 14 else 0 end - case when isbad then 100 else 0 end)::double score from exa)"""


SCORED = scored("cand")
#: Overrides before the candidates, ranks of all, and what speaks against each of them.
_o = "concat('https://cdn.example.com/o', n, '.jpg')"
OVERRIDES = f"""
ovr as (select "immutableKey", n, {_o} url, coalesce(nullif(case when n % 3 = 0 then 'https://brand.example.com/p' else '' end, ''), "sourcePage") page_url,
  case when n % 5 = 0 then '' else concat_ws(' ', brand, "productName", size) end alt, n % 2 = 0 confirmed from cat where n % 17 = 3)"""
JUDGED = f"""{OVERRIDES},
uni as (select "immutableKey", 0 s, 0::bigint o, url, page_url, 'manual-override' origin, alt, '' page_title, '' spn, '' sbr from ovr
  union all select "immutableKey", 1, disc_ord, url, page_url, origin, alt, page_title, spn, sbr from cand),
firsts as (select * from uni where not {bad('url')} qualify row_number() over (partition by "immutableKey", url order by s, o) = 1),
every as (select *, row_number() over (partition by "immutableKey" order by s, o, url) disc_ord from firsts),{scored('every')},
ranked as (select * from (select *, row_number() over (partition by "immutableKey" order by score desc, disc_ord) rk from scored) where rk <= 60),
refused as (select "immutableKey" k, url u from ranked where rk = 1 and disc_ord % 2 = 0 union select "immutableKey", url || '?r' from ranked where rk < 4 and disc_ord % 3 = 0),
tried as (select *, instr('0123456789abcdef', left(md5(url), 1)) h from ranked),
got as (select *, h <> 1 fetched, case h when 1 then null when 2 then url || '?r' when 3 then regexp_replace(url, '\\.jpg$', '') else url end final_url,
  h = 3 html, h = 4 blank from tried),
facts as (select g.*, coalesce(o.confirmed, false) sure, c.shared, regexp_matches(g.page_url, '[?&]attribute_') or regexp_matches(c."sourcePage", '[?&]attribute_') variable,
  (g."immutableKey", g.url) in (select (k, u) from refused) bad1, fetched and (g."immutableKey", coalesce(final_url, '')) in (select (k, u) from refused) bad2
  from got g join cat c using ("immutableKey") left join ovr o using ("immutableKey")),
judged as (select *, case when bad1 then 'previously rejected candidate skipped: ' || left(url, 120)
  when origin in ('og-image', 'twitter-image') and url_product_cov < 0.25 and url_brand_cov < 0.4 then 'og-image with no product/brand identity skipped: ' || left(url, 100)
  when brand_cov < 0.3 and product_cov < 0.5 then 'critically weak identity match skipped: brand_cov=' || printf('%.2f', brand_cov) || ' prod_cov=' || printf('%.2f', product_cov)
  when not fetched then origin || ': not fetched' when bad2 then 'previously rejected redirected candidate skipped: ' || left(final_url, 120)
  when html and not {direct('final_url')} then 'not image: ' || left(url, 120) when blank then origin || ': blank or near-blank image'
  when variable and not level_size_ok and not sure then 'variable product page without size evidence skipped: ' || left(url, 100) end skip,
  (exact and score >= 105 and origin in ('jsonld-product-image', 'shopify-product-json', 'woocommerce-gallery', 'woocommerce-gallery-srcset', 'manual-override') or sure)
  and (not (shared or variable) or level_size_ok and level_product_cov >= 0.8 and level_brand_cov >= 0.6 or sure) high from facts),
best as (select * from judged where skip is null qualify row_number() over (partition by "immutableKey" order by rk) = 1),
why as (select "immutableKey", array_to_string(list(skip order by rk)[1:6], '; ') why from judged where skip is not null group by 1)"""
RESULTS = f"""
res as (select "batchIndex", n, region, "immutableKey", brand, "productName", size, "targetJpgPath", st status, case when s then "currentImageReference" else '' end "resolvedImageUrl",
  case when s then "sourcePage" else '' end "evidencePage", case when s then sha256('b' || (n % 1500)) else '' end sha256,
  case when s then left(md5((n % 1200)::varchar), 16) else '' end "perceptualHash", case when s then 'staging/' || "batchIndex" else '' end "stagingPath"
  from (select *, n % 10 < 8 s, case when n % 10 = 9 then 'UNRESOLVED' when n % 10 = 8 then 'ERROR' when n % 10 < 3 then {q(scoring.HIGH)} else {q(scoring.REVIEW)} end st from cat))"""
SHEET = f"""
sheet as (select "immutableKey", "batchIndex", n, "resolvedImageUrl", "evidencePage", case when n % 4 = 0 then {q(r.APPROVED)} when n % 4 = 1 then {q(r.REJECTED)} when n % 8 = 2 then {q(r.REVIEW)}
  when n % 8 = 6 then '' else 'PENDING' end "manualVisualDecision", case when n % 8 = 0 then 'ann' else 'gemini-api' end reviewer, 'note' "evidenceNote",
  {', '.join(f"case when n % 4 = 0 and n % {40 + 8 * k} <> 0 then 'True' else '' end {chr(34)}{f}{chr(34)}" for k, f in enumerate(r.FLAGS))},
  {', '.join(f"case when n % 4 = 0 and n % 60 <> 0 then {chr(34)}{x}{chr(34)} else '' end {chr(34)}{f}{chr(34)}" for f, x in r.REVIEWED.items())}
  from res where n % 9 <> 7)"""
VERIFIED = f"""
ver as (select *, n % 23 <> 0 ok, 85 + n % 16 conf, case n % 3 when 0 then 'APPROVE' when 1 then 'REJECT' else 'REVIEW' end dec,
  {' and '.join(f'coalesce(n % 17 <> {k} and n % 19 <> {k}, false)' for k in range(len(r.CHECKS)))} good from res where n % 2 = 0 and {STAGED}),
decided as (select *, case when not ok then {q(r.REVIEW)} when dec = 'APPROVE' and conf >= 98 and good then {q(r.APPROVED)}
  when dec = 'REJECT' or conf >= 90 then {q(r.REJECTED)} else {q(r.REVIEW)} end nd from ver)"""
HUMAN = f"""
ev as (select event_id, ts, "immutableKey" ek, case event_type when 'purchase' then 'approve' when 'error' then 'reject' end d from events join cat on user_id = n where event_type in ('purchase', 'error')),
eff as (select ek, arg_max(d, (ts, event_id)) last, bool_or(d = 'approve') yes, bool_or(d = 'reject') no from ev group by ek)"""
MANIFEST = """
man as (select n + 1 row_no, "immutableKey", "assetId", case when n % 97 = 1 then '' when n % 97 = 2 then '/' || "targetJpgPath" when n % 97 = 3 then replace("targetJpgPath", '/', chr(92))
  when n % 97 = 4 then '../' || "targetJpgPath" when n % 97 = 5 then 'assets/' || "assetId" || '.png'
  when n % 97 = 6 then 'assets/product-images/catalogue-v28/000000000000000000000000.jpg' else "targetJpgPath" end path from cat)"""
PROBLEMS = f"""
own as (select *, list_last(string_split(rtrim(path, '/'), '/')) nm from man),
stems as (select *, case when regexp_matches(nm, '^.+\\.[^.]+$') then regexp_replace(nm, '\\.[^.]*$', '') else nm end stem from own),
probs as (select row_no, "immutableKey", unnest(list_filter([case when path = '' then 'EMPTY_PATH' end, case when contains(path, chr(92)) then 'BACKSLASH' end,
  case when starts_with(path, '/') then 'ABSOLUTE_PATH' end, case when list_contains(string_split(path, '/'), '..') then 'TRAVERSAL' end,
  case when not regexp_matches(path, {q(audit.TARGET)}) then 'SCHEMA_MISMATCH' end, case when stem <> "assetId" then 'ASSET_ID_FILENAME_MISMATCH' end], lambda x: x is not null)) problem, path from stems
  union all select row_no, "immutableKey", 'DUPLICATE_PATH_WITH_' || before, path from (select *, lag("immutableKey") over (partition by path order by row_no) before from man) where before is not null)"""
FILES = """
files as (select "stagingPath" path, case when n % 37 = 0 then 'undecodable' else '' end error, case when n % 31 = 0 then sha256('other') else sha256 end sha from res where "stagingPath" <> '' and n % 29 <> 0
  union all select "targetJpgPath", case when n % 43 = 0 then 'undecodable' else '' end, sha256 from res where n % 41 <> 0)"""


def _truthy(c: str) -> str:
    return f"coalesce(lower(trim({c})) in ({', '.join(q(x) for x in t.TRUTHY)}), false)"


def _joined(tests: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(tests)}], lambda x: x is not null), '; ')"


_missing = _joined([f"case when not {_truthy(f's.{chr(34)}{f}{chr(34)}')} then {q(m)} end" for f, m in publish.ATTESTATIONS.items()])
_differ = _joined([f"case when trim(coalesce(s.\"{f}\", '')) <> trim(coalesce(c.\"{x}\", '')) then {q(f + ' mismatch')} end" for f, x in r.REVIEWED.items()])
GATE = f"""
g0 as (select c.*, fs.sha, coalesce(case when x."immutableKey" is null then 'missing acquisition result' end,
  case when s."immutableKey" is null or s."manualVisualDecision" <> {q(r.APPROVED)} then 'not visually approved' end, nullif({_missing}, ''), nullif({_differ}, ''),
  case when x."stagingPath" = '' or fs.path is null then 'approved row missing staged image' end, case when fs.error <> '' then 'invalid JPEG: ' || fs.error end,
  case when fs.sha is distinct from x.sha256 then 'SHA-256 differs from acquisition record' end) early,
  coalesce(case when ff.path is null then 'final target JPG missing; rerun with --materialize-approved' end, case when ff.error <> '' then 'final target unreadable: ' || ff.error end) late
  from cat c left join res x using ("immutableKey") left join sheet s using ("immutableKey") left join files fs on x."stagingPath" = fs.path left join files ff on c."targetJpgPath" = ff.path),
gate as (select *, early is null passed_hash, coalesce(early, late) failure from g0),
fails as (select "immutableKey", failure reason from gate where failure is not null
  union all select sha, 'identical bytes approved across ' || k || ' incompatible identities' from (select sha, count(distinct (lower(trim(brand)), lower(trim("productName")), lower(trim(size)))) k from gate where passed_hash group by sha) where k > 1)"""
CONFLICTS = f"""
ids as (select *, concat_ws('|', {norm('brand')}, {norm('"productName"')}, array_to_string(list_sort({sizes('size')}), ',')) i from res),
bad_sha as (select sha256 d from ids where sha256 <> '' group by 1 having count(distinct i) > 1),
bad_ph as (select "perceptualHash" d from ids where "perceptualHash" <> '' group by 1 having count(distinct i) > 1)"""


CHUNK_STATUS = "case when (n + 1) % 9 = 0 then 'THIRD' when (n + 1) % 3 = 0 then 'SECOND' else status end"


def three_passes() -> str:
    """Each pass takes a row's first candidate that nothing speaks against and that isn't rejected yet. Rejections follow
    from the URL, so what a pass takes follows from the rejections before it; approved rows keep the marks they had."""
    key = '"immutableKey"'
    slug = "concat_ws('-', replace(\"productName\", ' ', '-'), replace(size, ' ', '-'))"
    shop = "'https://shop' || n % 37 || '.example.com'"
    outcome = "case when h < 7 then 'approve' when h < 11 then 'reject' when h < 14 then 'doubt' else 'error' end"
    parts = [CATALOGUE, DOMAINS, RESULTS, OVERRIDES.replace('"sourcePage"', f"{shop} || '/products/' || n"), f"""
store as (select {key}, n, unnest([0, 1, 2]) k, {shop} shop, {slug} slug, brand, "productName" from cat where not shared and not barcode),
uni as (select {key}, 0 s, 0::bigint o, url, page_url, 'manual-override' origin, alt, '' page_title, '' spn, '' sbr from ovr
  union all select {key}, 1, 0, "currentImageReference", {shop} || '/products/' || n, 'direct-current-image', "productName", '', '', '' from cat where n % 3 = 0
  union all select {key}, 2, k, shop || '/i/' || case k when 0 then slug || '.jpg' when 1 then replace("productName", ' ', '-') || '-b.jpg' else 'item-' || n || '.jpg' end,
    shop || '/products/' || n, 'shopify-product-json', "productName", '', "productName", brand from store),
firsts as (select * from uni where not {bad('url')} qualify row_number() over (partition by {key}, url order by s, o) = 1),
every as (select *, row_number() over (partition by {key} order by s, o, url) disc_ord from firsts),{scored('every')},
tried as (select *, row_number() over (partition by {key} order by score desc, disc_ord) rk, instr('0123456789abcdef', left(md5(url), 1)) f from scored),
open as (select t.{key} k, t.url, case f when 2 then t.url || '?r' when 3 then regexp_replace(t.url, '\\.jpg$', '') else t.url end final_url, origin, score, rk, sha256(left(md5(t.url), 3)) sha, md5(t.url) ph,
  (exact and score >= 105 and origin in ('shopify-product-json', 'manual-override') or coalesce(o.confirmed, false))
  and (not c.shared or level_size_ok and level_product_cov >= 0.8 and level_brand_cov >= 0.6 or coalesce(o.confirmed, false)) high
  from tried t join cat c using ({key}) left join ovr o using ({key}) where not (brand_cov < 0.3 and product_cov < 0.5) and f not in (1, 3, 4)),
judge as (select *, {outcome} outcome from (select *, instr('0123456789abcdef', left(md5(final_url), 1)) h from open)),
who as (select {key} k, concat_ws('|', {norm('brand')}, {norm('"productName"')}, array_to_string(list_sort({sizes('size')}), ',')) i from cat),
rej0 as (select {key} k, "resolvedImageUrl" u from res where n % 6 = 0 and {STAGED})"""]
    for p in (1, 2, 3):
        parts.append(f"""
left{p} as (select j.* from judge j anti join rej{p - 1} a on j.k = a.k and j.url = a.u),
take{p} as (select j.*, i from left{p} j anti join rej{p - 1} b on j.k = b.k and j.final_url = b.u join who on who.k = j.k qualify row_number() over (partition by j.k order by rk) = 1),
same{p} as (select sha d from take{p} group by 1 having count(distinct i) > 1 union select ph from take{p} group by 1 having count(distinct i) > 1),
pick{p} as (select t.*, sha in (select d from same{p}) or ph in (select d from same{p}) twice from take{p} t),
rej{p} as (select * from rej{p - 1} union select k, final_url from pick{p} where outcome in ('reject', 'doubt'))""")
    parts.append("""
final as (select * from pick1 where outcome = 'approve' union all select * from pick2 where outcome = 'approve' and k not in (select k from pick1 where outcome = 'approve')
  union all select * from pick3 where k not in (select k from pick1 where outcome = 'approve') and k not in (select k from pick2 where outcome = 'approve')),
nrej as (select k, count(*) c from rej3 group by 1)""")
    return sql(*parts, f"""select {key}, case when f.k is null then 'UNRESOLVED' when twice then {q(CONFLICT)} when high then {q(scoring.HIGH)} else {q(scoring.REVIEW)} end status, final_url "resolvedImageUrl", origin,
      round(score, 2) "imageCandidateScore", coalesce(high and not twice, false) "autoApprovalEligible",
      case outcome when 'approve' then {q(r.APPROVED)} when 'reject' then {q(r.REJECTED)} when 'doubt' then {q(r.REVIEW)} when 'error' then {q(r.REVIEW)} else 'PENDING' end "manualVisualDecision", coalesce(c, 0) n_rejected
      from cat left join final f on f.k = {key} left join nrej x on x.k = {key}""")


def sql(*parts: str) -> str:
    return "with " + ",".join(parts[:-1]) + "\n" + parts[-1] if len(parts) > 1 else parts[0]


def _counts(name: str, table: str, label: str) -> str:
    return f"(select string_agg(k || '=' || c, ';' order by k) from (select {label} k, count(*) c from {table} group by 1)) \"{name}\""


#: Suppliers by turn, with the cells of their drawings in pixels and the bytes of the image; turns from 8 have none.
DRAWN = """drawn as (select s_suppkey, s_suppkey::bigint k, t, case when t < 6 then 40 when t = 6 then 13 when t = 7 then 32 end w, case when t < 6 then 40 when t = 6 then 13 when t = 7 then 192 end h,
  case when t < 6 then 5888 when t = 6 then 2048 when t = 7 then 27904 end size from (select *, (s_suppkey % 10)::int t from supplier)),
sized as (select *, coalesce(w * 8, -1)::int width, coalesce(h * 8, -1)::int height, (case t when 8 then 3001 when 9 then 5 else size + 311 end)::bigint length from drawn)"""


def drawing_checks() -> str:
    """Quality, hashes and checks of the drawings. Resampling weights are added up by cell, as cells are of one colour."""
    colour = lambda c: f"(k * 37 + j * j * 11 + j * (k % 13) * 29 + {c} * 53) % 127"
    short = lambda n: f"concat(chr(({n} % 256)::int), chr(({n} // 256)::int))"
    whole = lambda n: f"concat({short(n)}, chr(0), chr(0))"
    head = ", ".join(["'BM'", *map(whole, ("(size + 310)", "0", "310", "40", "(w * 8)", "(h * 8)")), short("1"), short("8"), *map(whole, ("1", "size", "0", "0", "64", "64"))])
    byte = lambda x: f"greatest(0, least(255, floor(({x} + 2097152) / 4194304)))"
    grid = lambda name, nx, ny, source: f"""{name}_h as (select c.k, c.c, c.y, c.w, c.h, wx.o ox, {byte("sum(wx.g * c.v)")} v from {source} c join weights wx on wx.n = c.w * 8 and wx.m = {nx} and wx.cell = c.x group by all),
{name} as (select a.k, a.c, a.ox, wy.o oy, {byte("sum(wy.g * a.v)")} v from {name}_h a join weights wy on wy.n = a.h * 8 and wy.m = {ny} and wy.cell = a.y group by all)"""  # noqa: E731
    return sql(
        DRAWN,
        f"""texts as (select k, case t when 8 then repeat('x', 3000) when 9 then 'tiny' else concat({head},
    (select string_agg(concat(chr(({colour(2)})::int), chr(({colour(1)})::int), chr(({colour(0)})::int), chr(0)), '' order by i) from (select i, case when t = 5 then 0 else i end j from range(64) r(i))),
    (select string_agg(repeat(concat((select string_agg(concat(chr(w), chr((y * 8 + x)::int)), '' order by x) from range(8) b(x)), chr(0), chr(0)), h), '' order by y desc) from range(8) a(y)),
    chr(0), chr(1), repeat(chr(0), size - h * 8 * 18 - 2)) end || chr(10) as content from drawn)""",
        f"""cells as (select k, w, h, i % 8 x, i // 8 y, c, case c when 0 then {colour(0)} when 1 then {colour(1)} else {colour(2)} end v
    from (select *, case when t = 5 then 0 else i end j from drawn, range(64) r(i), range(3) s(c) where t < 8))""",
        "greys as (select k, w, h, x, y, 0 c, (sum(v * case c when 0 then 19595 when 1 then 38470 else 7471 end)::bigint + 32768) // 65536 v from cells group by k, w, h, x, y)",
        "axes as (select distinct n, m, n / m scale, greatest(n / m, 1.0::double) wide from (select unnest([w, h]) * 8 n from drawn), (select unnest([8, 9, 96, 128]) m) where n is not null)",
        "spans as (select *, (o + 0.5::double) * scale mid from (select *, unnest(range(m)) o from axes))",
        "ends as (select *, greatest(trunc(mid - 2 * wide + 0.5::double), 0)::bigint lo, least(trunc(mid + 2 * wide + 0.5::double), n)::bigint hi from spans)",
        "taps as (select *, abs((p - mid + 0.5::double) / wide) d from (select *, unnest(range(lo, hi)) p from ends))",
        "cubics as (select *, case when d < 1 then (1.5::double * d - 2.5::double) * d * d + 1 when d < 2 then -0.5::double * (d * d * d - 5 * d * d + 8 * d - 4) else 0 end q from taps)",
        "weights as (select n, m, o, p * 8 // n cell, sum(g)::bigint g from (select *, round(q / sum(q) over (partition by n, m, o) * 4194304)::bigint g from cubics) group by all)",
        grid("fine", 128, 128, "cells"), grid("mid", 96, 96, "cells"), grid("tiny", 9, 8, "greys"),
        "ent as (select k, -sum(p * log2(p)) entropy from (select k, count(*) / 49152.0::double p from fine group by k, c, v) group by k)",
        "spread as (select k, avg(sd) stddev from (select k, stddev_pop(v) sd from mid group by k, c) group by k)",
        "bits as (select k, oy, sum(case when v > after then (1 << ox) else 0 end)::int bits from (select *, lead(v) over (partition by k, oy order by ox) after from tiny) where ox < 8 group by k, oy)",
        "hashed as (select k, string_agg(printf('%02x', bits), '' order by oy desc) dhash from bits group by k)",
        """select s.s_suppkey::bigint s_suppkey, length, width, height, round(entropy, 6) entropy, round(stddev, 6) stddev, dhash, sha256(content) sha256,
  case when length < 2000 then 'image smaller than 2 KB' when width <= 0 then 'undecodable image' when least(width, height) < 240 then concat('dimensions too small: ', width, 'x', height)
    when width / height < 0.18 or width / height > 5.5 then concat('extreme aspect ratio: ', printf('%.3f', width / height)) when entropy < 2 or stddev < 4 then 'blank or near-blank image' else '' end error,
  case when width <= 0 then 'undecodable' else 'format is not JPEG' end jpeg_error
from sized s join texts using (k) left join ent using (k) left join spread using (k) left join hashed using (k)""",
    )


def oracle_sql() -> dict[str, str]:
    key = '"immutableKey"'
    img = "concat('https://pages.example.com/', page_id)"
    out = {
        "b1_b4_text": f"select doc_id, md5({norm('text')}) norm_md5, len({tokens('text')})::int n_tokens, md5(array_to_string({tokens('text')}, ',')) tokens_md5, array_to_string(list_sort({sizes('text')}), ',') sizes from documents",
        "b1_references": f"select p_partkey, md5({norm_plain('x')}) norm_md5 from (select p_partkey, concat_ws(' ', p_name, p_partkey || {texts(list(REFERENCES.values()))}[p_partkey % {len(REFERENCES)} + 1] || 'mg', p_brand) x from part)",
        "b3_b5_coverage": f"with p as (select p_partkey, {tokens('''concat_ws(' ', p_name, p_brand)''')} need, {tokens('''concat_ws(' ', p_type, p_brand)''')} hay, {sizes('''concat_ws(' ', p_size, 'caps')''')} want, {sizes(q('10 capsules'))} have from part) select p_partkey, round({cover('need', 'hay')}, 6) coverage, {fits('want', 'have')} size_match from p",
        "b6_b12_identity": sql(CATALOGUE, f"""select {key}, concat_ws(':', region, "productId", "variantIndex") composed, concat_ws('|', {norm('brand')}, {norm('"productName"')}, array_to_string(list_sort({sizes('size')}), ',')) "identity",
          concat_ws('|', lower(trim(brand)), lower(trim("productName")), lower(trim(size))) plain, shared truthy, 'n' note, '/' || "targetJpgPath" src,
          concat(case when length("batchIndex") < 5 then lpad("batchIndex", 5, '0') else "batchIndex" end, '_', "assetId", '.jpg') staging from cat"""),
        "c2_c12_urls": f"""with p as (select page_id, url || ['/a%20b+c.JPG', '?attribute_x=1', '/silicon.png?x', '#top'][page_id % 4 + 1] u from pages), d as (select *, {domain('u')} dm from p), e as (select *, ['example.org', substring(dm, 2, 100), 'com'] ds from d)
          select page_id, dm "domain", {unquote('u')} unquoted, {bad('u')} bad, {direct('u')} direct, regexp_matches(u, '[?&]attribute_') variable, len(list_filter(ds, lambda x: dm = x or ends_with(dm, '.' || x))) > 0 official,
          len(list_filter(ds, lambda x: ends_with(dm, x))) > 0 loose, dm in ({', '.join(q(x) for x in u.BAD_PAGE_DOMAINS)}) bad_page from e""",
        "c13_e1_search_query": sql(CATALOGUE, DOMAINS, f"""select {key}, array_to_string(domains, ',') domains, case when len(domains) > 0
          then concat('(', array_to_string(list_transform(domains[1:3], lambda d: 'site:' || d), ' OR '), ') ', "productName", ' ', size) else concat('"', brand, '" "', "productName", '" "', size, '" buy product') end query from catd"""),
        "d1_page_titles": "select page_id, trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) title from pages",
        "d3_d8_candidates": f"""select {img} page_url, unnest([0, 1, 2, 4]::bigint[]) disc_ord, unnest([concat('https://pages.example.com/ld', page_id, '.jpg'), concat('https://pages.example.com/og', page_id % 3, '.png'), concat('https://pages.example.com/p', page_id, '.jpg'), concat('https://cdn.example.com/q', page_id, '.jpg')]) url,
          unnest(['jsonld-product-image', 'og-image', 'woocommerce-gallery', 'woocommerce-gallery-srcset']) origin, unnest([concat('Item ', page_id), '', concat('Item ', page_id), concat('Item ', page_id)]) alt, unnest([concat('B', page_id % 5), '', '', '']) structured_brand from pages""",
        "d2_products": f"""select {img} page_url, 0::bigint ord, concat('Item ', page_id) name, concat('B', page_id % 5) brand, concat('{{"@type": ["Thing", "product"], "name": "Item ', page_id, '", "brand": {{"name": "B', page_id % 5, '"}}, "image": ["/ld', page_id, '.jpg"]}}') json from pages""",
        "a1_a2_csv": sql(CATALOGUE, f"""select size, {key}, '"' || "productName" || '",' || chr(10) || brand "productName", '' absent, "sourcePage", '' never from cat"""),
        "a4_json": sql(CATALOGUE, """w as (select lower(trim(brand)) b, lower(trim("productName")) p, lower(trim(size)) s, count(*) n from cat group by all)""",
          """select (select count(distinct brand) from cat) brands, 0::bigint "blankBrands", 0::bigint "blankNames", 0::bigint "blankSizes", count(*) filter (n > 1) "repeatedIdentityGroups", coalesce(sum(n) filter (n > 1), 0)::bigint "repeatedIdentityRows",
          (select count(*) from (select b, p from w group by all having count(*) > 1)) "multiSizeGroups" from w"""),
        "a3_regions": sql(CATALOGUE, """select region, "productId", "currentImageReference" "imageSrc" from cat"""),
        "a7_slice": sql(CATALOGUE, f"""select {key}, "batchIndex" from cat order by n limit 50 offset 100"""),
        "c9_c11_wrapped_urls": """with p as (select p_partkey, 'https://shop.example.com/p/' || p_partkey || '?q=a b&c=' || chr(233) page from part)
          select p_partkey, page resolved, page redirected, case when p_partkey % 2 = 0 then lpad(p_partkey::varchar, 12, '0') else '' end barcode,
          case when p_partkey % 2 = 0 then 'https://www.barcodelookup.com/' || lpad(p_partkey::varchar, 12, '0') else page end same from p""",
        "d9_rendered": f"""with i as (select 'https://pages.example.com/' || l_partkey page_url, (l_orderkey * 100 + l_linenumber * 10 + l_suppkey % 10)::bigint disc_ord,
          case l_linenumber % 6 when 0 then 'data:' when 1 then 'https://cdn.example.com/site-logo' else 'https://cdn.example.com/i' end || (l_suppkey % 5) || '.jpg' url,
          case when l_linenumber % 4 = 0 then 'browser-og' else 'browser-img' end origin, l_returnflag alt, case when l_quantity < 5 then 0 else trunc(l_quantity * 20)::int end w, trunc(l_quantity * 9)::int h from lineitem)
          select page_url, disc_ord, url, origin, alt from i where origin = 'browser-og' or (starts_with(url, 'http') and not contains(url, 'logo') and not (w <> 0 and h <> 0 and least(w, h) < 180))
          qualify row_number() over (partition by page_url, url order by disc_ord) = 1""",
        "d12_rendered_search": sql(CATALOGUE, DOMAINS, CANDIDATES, f"""
          hits as (select c.{key} k, disc_ord, case when disc_ord % 4 = 0 then replace(page_url, 'www.supplier', 'www.amazon.supplier') else page_url end u, domains from cand c join catd d on c.{key} = d.{key}),
          ok as (select k, u, min(disc_ord) ro, min(case when len(list_filter(domains, lambda d: ends_with({domain('u')}, d))) > 0 then 0 else 1 end) pr from hits where not contains({domain('u')}, 'amazon.') group by 1, 2)""",
          f"select k {key}, page_ord::int page_ord, u page_url from (select *, row_number() over (partition by k order by pr, ro, u) page_ord from ok) where page_ord <= 6"),
        "a5_a6_image_files": sql(DRAWN, "select s_suppkey::bigint s_suppkey, length, width, height, (case when t < 8 then 3 else -1 end)::int channels from sized"),
        "g1_g4_images": drawing_checks(),
        "e3_overrides": sql(CATALOGUE, OVERRIDES, f"select {key}, 0::bigint disc_ord, url, page_url, 'manual-override' origin, alt from ovr"),
        "e5_page_join": sql(CATALOGUE, f"""select {key}, 2000000 + i disc_ord, "sourcePage" || '/i' || i || '.jpg' url from cat, (select unnest([0, 1]) i)"""),
        "e6_flag_rejected": sql(CATALOGUE, CANDIDATES, f"""bad as (select distinct {key}, url from cand where disc_ord % 3 = 0 union select {key}, page_url from cand where disc_ord % 5 = 0)""",
          f"""select c.{key}, disc_ord, b.url is not null was_rejected, d.url is not null page_rejected from cand c left join bad b on b.{key} = c.{key} and b.url = c.url left join bad d on d.{key} = c.{key} and d.url = c.page_url"""),
        "f12_proposals": sql(CATALOGUE, DOMAINS, CANDIDATES, SCORED, RESULTS, OVERRIDES, f"""new as (select {key}, url, page_url, left(concat_ws(' | ', alt, page_title), 500) note from scored where score >= 55 and {key} not in (select {key} from res where {STAGED})
          qualify row_number() over (partition by {key} order by score desc, disc_ord) = 1)""",
          f"""select {key}, url "approvedDirectImageUrl", page_url "approvedSourcePageUrl", 'false' "exactVariantConfirmed", '' reviewer, note "evidenceNote" from new
          union all select {key}, url, case when n % 3 = 0 then 'https://brand.example.com/p' else '' end, case when n % 2 = 0 then 'True' else 'false' end, 'ann', alt from ovr where {key} not in (select {key} from new)"""),
        "d7_store_json": """with p as (select p_partkey, p_name, p_brand, list_filter([case when p_partkey % 2 = 0 then concat('https://cdn.example.com/f', p_partkey, '.jpg') end, concat('https://shop.example.com/i', p_partkey, '.png')], lambda x: x is not null) us from part)
          select concat('https://shop.example.com/products/', p_partkey) page_url, (i - 1)::bigint disc_ord, us[i] url, p_name alt, p_brand structured_brand from (select *, unnest(generate_series(1, len(us))) i from p)""",
        "d10_row_pages": sql(CATALOGUE, f"""select {key}, (i - 1)::int page_ord, ps[i] page_url from (select *, unnest(generate_series(1, len(ps))) i from (select {key}, list_filter([case when not shared and not barcode then "sourcePage" end, case when not shared then "currentImageReference" end], lambda x: x is not null) ps from cat))"""),
        "d11_search_results": sql(CATALOGUE, DOMAINS, CANDIDATES, f"""
          hits as (select c.{key} k, disc_ord, page_url, {domain('page_url')} dm, regexp_extract_all(lower(concat_ws(' ', alt, page_url)), '[a-z0-9]+') words, list_concat({tokens('d.brand')}, {tokens('d."productName"')}) toks, domains from cand c join catd d on c.{key} = d.{key}),
          ok as (select k, page_url, min(disc_ord) ro, min(case when len(list_filter(domains, lambda d: ends_with(dm, d))) > 0 then 0 else 1 end) pr from hits where len(toks) = 0 or list_has_any(words, toks) or len(list_filter(domains, lambda d: dm = d or ends_with(dm, '.' || d))) > 0 group by 1, 2)""",
          f"select k {key}, page_ord::int page_ord, page_url from (select *, row_number() over (partition by k order by pr, ro, page_url) page_ord from ok) where page_ord <= 8"),
        "d13_needs_search": sql(CATALOGUE, CANDIDATES, f"select {key} from cat c where shared or barcode or not exists (select 1 from cand where cand.{key} = c.{key} and disc_ord % 3 = 0)"),
        "e2_assemble": sql(CATALOGUE, CANDIDATES, f"""uni as (select {key}, 0 s, 0 o, "currentImageReference" url, 'direct-current-image' origin from cat where {direct('"currentImageReference"')} union all select {key}, 1, disc_ord, url, origin from cand),
          one as (select {key}, url, arg_min(origin, (s, o)) origin, min((s, o)) place from uni where not {bad('url')} group by 1, 2)""", f"select {key}, (row_number() over (partition by {key} order by place, url))::int disc_ord, url, origin from one"),
        "f1_f2_f10_best_evidence": sql(CATALOGUE, DOMAINS, CANDIDATES, SCORED, f"select {key}, url, origin, round(brand_cov, 6) brand_cov, round(product_cov, 6) product_cov, size_ok, exact, round(score, 6) score from (select *, row_number() over (partition by {key} order by score desc, disc_ord) rk from scored) where rk = 1"),
        "f3_top_ranked": sql(CATALOGUE, DOMAINS, CANDIDATES, SCORED, f"select {key}, rk::int \"rank\", disc_ord, round(score, 6) score from (select *, row_number() over (partition by {key} order by score desc, disc_ord) rk from scored) where rk <= 5"),
        "f4_f11_selected": sql(CATALOGUE, DOMAINS, CANDIDATES, JUDGED, f"""select {key}, case when b.url is null then 'UNRESOLVED' when high then {q('STAGED_HIGH_CONFIDENCE_NEEDS_VISUAL_REVIEW')} else {q('STAGED_NEEDS_MANUAL_REVIEW')} end status,
          final_url "resolvedImageUrl", page_url "evidencePage", origin, case when b.url is not null then sha256(b.url) end sha256, round(brand_cov, 3) "pageBrandCoverage", round(product_cov, 3) "pageProductCoverage", coalesce(size_ok, false) "exactSizeEvidence",
          round(score, 2) "imageCandidateScore", coalesce(high, false) "autoApprovalEligible",
          case when b.url is not null then 'Candidate bytes decoded and staged; exact brand, product name, and package must still be visually approved.' else coalesce(why, 'no exact image candidate found') end reason,
          case when b.url is not null then concat('staging/', case when length("batchIndex") < 5 then lpad("batchIndex", 5, '0') else "batchIndex" end, '_', "assetId", '.jpg') end "stagingPath"
          from cat c left join best b using ({key}) left join why using ({key})"""),
        "h1_byte_conflicts": sql(CATALOGUE, RESULTS, CONFLICTS, f"select 'sha256' \"conflictType\", sha256 digest, {key} from res where sha256 in (select d from bad_sha)"),
        "h1_text_conflicts": f"select sha256(text) digest, count(*)::bigint n_rows, count(distinct ({norm('lang')}, {norm('source')})) n_identities from documents where text is not null group by 1 having count(distinct ({norm('lang')}, {norm('source')})) > 1",
        "h3_conflict_report": sql(CATALOGUE, RESULTS, CONFLICTS, f"""select 'sha256' "conflictType", sha256 digest, {key}, status from res where sha256 in (select d from bad_sha)
          union all select 'phash', "perceptualHash", {key}, case when sha256 in (select d from bad_sha) then {q(CONFLICT)} else status end from res where "perceptualHash" in (select d from bad_ph)"""),
        "h4_marked": sql(CATALOGUE, RESULTS, CONFLICTS, f"""select {key}, case when hit then {q(CONFLICT)} else status end status, 'false' "autoApprovalEligible", case when hit then {q(REASON)} else '' end reason
          from (select *, {STAGED} and (sha256 in (select d from bad_sha) or "perceptualHash" in (select d from bad_ph)) hit from res)"""),
        "i1_resume": sql(CATALOGUE, RESULTS, FILES, f"""kept as (select {key} from res where {STAGED} and "stagingPath" in (select path from files where error = ''))""", f"select {key}, 'kept' part from kept union all select {key}, 'todo' from cat where {key} not in (select {key} from kept)"),
        "i2_merged_results": sql(CATALOGUE, RESULTS, f"select {key}, case when (n + 1) % 5 = 0 then 'NEW' else status end status from res"),
        "i3_override_todo": sql(CATALOGUE, RESULTS, f"select {key} from res where n % 50 in (0, 8, 9) and not {STAGED}"),
        "i4_chunks": sql(CATALOGUE, RESULTS, f"select {key}, {CHUNK_STATUS} status from res"),
        "l2_stream": sql(CATALOGUE, RESULTS, f"select {key}, {CHUNK_STATUS} status from res"),
        "k7_passes": three_passes(),
        "i5_review_sheet": sql(CATALOGUE, RESULTS, SHEET, f"""select r.{key}, coalesce(s."manualVisualDecision", 'PENDING') "manualVisualDecision", coalesce(s.reviewer, '') reviewer, coalesce(s."brandExact", '') "brandExact", coalesce(s."reviewedBrand", '') "reviewedBrand", r.status from res r left join sheet s using ({key})"""),
        "i6_acquisition_summary": sql(CATALOGUE, RESULTS, CONFLICTS, f"""marked as (select *, case when {STAGED} and (sha256 in (select d from bad_sha) or "perceptualHash" in (select d from bad_ph)) then {q(CONFLICT)} else status end st from res)""",
          f"""select count(*) "scopeRows", {_counts('statusCounts', 'marked', 'st')}, count(*) filter (starts_with(st, 'STAGED')) "stagedRows", count(*) filter (not starts_with(st, 'STAGED')) "unresolvedRows", count(distinct sha256) filter (sha256 <> '') "uniqueDownloadedJpgBytes",
          count(distinct {key}) filter (sha256 in (select d from bad_sha) or "perceptualHash" in (select d from bad_ph)) "duplicateConflictRows" from marked"""),
        "i7_pending": sql(CATALOGUE, RESULTS, SHEET, f"select {key} from res where {STAGED} and {key} not in (select {key} from sheet where \"manualVisualDecision\" in ({q(r.APPROVED)}, {q(r.REJECTED)}, {q(r.REVIEW)}))"),
        "i8_i9_decisions": sql(CATALOGUE, RESULTS, VERIFIED, f"select {key}, nd decision from decided"),
        "i10_verified": sql(CATALOGUE, RESULTS, SHEET, VERIFIED, f"""b as (select coalesce(s.{key}, d.{key}) k, s.*, d.ok, d.conf, d.dec, d.nd, d.n dn, d.brand db, d.{key} is not null and not coalesce(s."manualVisualDecision" = {q(r.APPROVED)} and s.reviewer not in ('gemini', 'gemini-api'), false) use from sheet s full join decided d on s.{key} = d.{key})""",
          f"""select k {key}, case when use then nd else "manualVisualDecision" end "manualVisualDecision", case when use then 'gemini-api' else reviewer end reviewer,
          case when use and nd = {q(r.APPROVED)} then 'AI strict approval at ' || conf || '%: seen' when use and ok then 'why ' || dn when use then coalesce("evidenceNote", '') else "evidenceNote" end "evidenceNote",
          case when use and nd = {q(r.APPROVED)} then 'true' else coalesce("brandExact", '') end "brandExact", case when use and nd = {q(r.APPROVED)} then db else coalesce("reviewedBrand", '') end "reviewedBrand",
          case when use then case when ok then dec else 'ERROR' end else '' end "aiDecision", case when use and ok then conf::varchar else '' end "aiConfidence" from b"""),
        "i11_rejected": sql(CATALOGUE, RESULTS, SHEET, VERIFIED, f"""old as (select {key}, "resolvedImageUrl", "evidencePage", 'old' reason, '' "aiConfidence", 't0' "rejectedAt" from res where n % 6 = 0 and {STAGED}),
          new as (select {key}, "resolvedImageUrl", "evidencePage", 'why ' || n reason, conf::varchar "aiConfidence", '2020-01-01T00:00:00Z' "rejectedAt" from decided where ok and nd <> {q(r.APPROVED)} and {key} not in (select {key} from sheet where "manualVisualDecision" = {q(r.APPROVED)} and reviewer not in ('gemini', 'gemini-api')))""",
          f'select * from new union all select * from old where ({key}, "resolvedImageUrl") not in (select ({key}, "resolvedImageUrl") from new)'),
        "i12_full_review": sql(CATALOGUE, RESULTS, SHEET, f"""select c.{key}, c."batchIndex", coalesce(s."manualVisualDecision", 'PENDING') "manualVisualDecision", coalesce(s.reviewer, '') reviewer from cat c left join sheet s using ({key})"""),
        "i13_decision_counts": sql(CATALOGUE, RESULTS, SHEET, """select coalesce(nullif("manualVisualDecision", ''), 'PENDING') decision, count(*) n from sheet group by 1"""),
        "i14_retry": sql(CATALOGUE, RESULTS, SHEET, f"""hit as (select {key} from sheet where "manualVisualDecision" in ({q(r.REJECTED)}, {q(r.REVIEW)}))""",
          f"""select r.{key}, case when h then {q(r.RETRY)} else status end status, case when h then '' else sha256 end sha256, case when h then 'PENDING' else s."manualVisualDecision" end "manualVisualDecision", case when h then '' else s.reviewer end reviewer,
          case when h and "stagingPath" <> '' then "stagingPath" end path from (select *, {key} in (select {key} from hit) h from res) r left join sheet s using ({key})"""),
        **dict.fromkeys(("i15_human_decisions", "l1_stream"), sql(CATALOGUE, RESULTS, SHEET, HUMAN, f"""select s.{key}, case when last = 'approve' then {q(r.APPROVED)} when last = 'reject' then {q(r.REJECTED)} else "manualVisualDecision" end "manualVisualDecision", case when last is not null then 'human-local-review' else reviewer end reviewer,
          case when yes then 'true' else "brandExact" end "brandExact", case when yes then c.brand else "reviewedBrand" end "reviewedBrand" from sheet s left join eff on ek = s.{key} left join cat c on c.{key} = s.{key}""")),
        "i15_human_rejected": sql(CATALOGUE, RESULTS, HUMAN, f"""old as (select {key}, "resolvedImageUrl", "evidencePage", 'old' reason, '' "aiConfidence", 't0' "rejectedAt" from res where n % 6 = 0 and {STAGED})""",
          f"""select * from old union all select {key}, "resolvedImageUrl", "evidencePage", 'Human rejected candidate as wrong or uncertain.', '', '2020-01-01T00:00:00Z' from res where {key} in (select ek from eff where no) and "resolvedImageUrl" <> '' and {key} not in (select {key} from old)"""),
        "j1_j2_path_problems": sql(CATALOGUE, MANIFEST, PROBLEMS, "select * from probs"),
        "j3_staged_missing": sql(CATALOGUE, RESULTS, FILES, f"""select {key} from res where {STAGED} and "stagingPath" not in (select path from files where error = '')"""),
        "j4_path_report": sql(CATALOGUE, MANIFEST, PROBLEMS, """select count(*) "rowsChecked", count(distinct path) "uniquePaths", (select count(*) from probs) "pathProblems", (select count(*) from probs) = 0 pass,
          (select string_agg(concat_ws(' ', row_no, "immutableKey", problem, path), ';' order by row_no, problem) from (select * from probs order by row_no, problem, "immutableKey" limit 100)) "problemsPreview" from man"""),
        "j5_reconcile": sql(CATALOGUE, MANIFEST, f"""s as (select {key} sk, "targetJpgPath" sp from cat where (n + 1) % 13 <> 0), m as (select {key} mk, path mp from man where row_no % 11 <> 0)""",
          "select case when mk is null then 'missing_in_manifest' when sk is null then 'missing_in_source' when sp <> mp then 'mapping_mismatch' else 'match' end kind, count(*) n from s full join m on sk = mk group by 1"),
        "j6_identity_audit": sql(CATALOGUE, """w as (select lower(trim(brand)) b, lower(trim("productName")) p, lower(trim(size)) s, count(*) n from cat group by all)""",
          """select (select count(distinct brand) from cat) brands, 0::bigint "blankBrands", 0::bigint "blankNames", 0::bigint "blankSizes", count(*) filter (n > 1) "repeatedIdentityGroups", coalesce(sum(n) filter (n > 1), 0)::bigint "repeatedIdentityRows",
          (select count(*) from (select b, p from w group by all having count(*) > 1)) "multiSizeGroups" from w"""),
        "j7_shared_pages": sql(CATALOGUE, f"""i as (select "sourcePage", concat_ws('|', {norm('brand')}, {norm('"productName"')}, array_to_string(list_sort({sizes('size')}), ',')) i from cat)""", """select "sourcePage", count(distinct i) n_identities, count(*) n_rows from i group by 1 having count(distinct i) > 1"""),
        "j8_corrected": sql(CATALOGUE, f"""select {key}, case when shared then '' else "sourcePage" end "sourcePage", case when shared then '' else "currentImageReference" end "currentImageReference" from cat"""),
        "j9_scope": sql(CATALOGUE, f"""select coalesce(region, 'ALL') region, count(*) "rows", count(distinct {key}) keys, count(distinct "currentImageReference") images, count(*) filter ("sourceClass" = 'official-manufacturer-product-page') official, count(*) filter (shared) shared, count(*) filter (barcode) barcode from cat group by rollup (region)"""),
        "j10_domain_weights": sql(CATALOGUE, """select brand, lower("sourceDomain") "officialDomain", count(*) "evidenceWeight" from cat where "sourceClass" = 'official-manufacturer-product-page' group by 1, 2"""),
        "k1_gate": sql(CATALOGUE, RESULTS, SHEET, FILES, GATE, f"select {key}, coalesce(failure, '') failure, passed_hash from gate"),
        "h5_k1_failures": sql(CATALOGUE, RESULTS, SHEET, FILES, GATE, "select * from fails"),
        "k2_k3_regional": sql(CATALOGUE, RESULTS, SHEET, FILES, GATE, f"""select region, "productId", "variantIndex", case when ok then '/' || "targetJpgPath" else "currentImageReference" end "imageSrc", case when ok then 'product' else 'external' end "imageKind", case when ok then 'True' else 'False' end "imageTrusted",
          case when ok then {q(publish.METHOD)} else 'none' end "imageResolutionMethod", case when ok then {q(r.APPROVED)} else 'OLD' end "imageMatchStatus", case when ok then trim(note || {q(' | ' + publish.NOTE)}, ' |') else note end "imageNotes", "productName"
          from (select *, failure is null ok, case when (n + 1) % 2 = 0 then 'kept' else '' end note from gate)"""),
        "k4_validation": sql(CATALOGUE, RESULTS, SHEET, FILES, GATE, f"""select count(*) "scope", 2000::bigint expected, count(*) filter (failure is null) "approvedAndMaterialized", (select count(*) from fails) "failureCount", {_counts('regions', 'cat', 'region')}, false pass,
          {_counts('approvedRegions', '(select * from gate where failure is null)', 'region')}, {_counts('reasons', 'fails', 'reason')},
          (select string_agg({key} || ' ' || reason, ';' order by {key}, reason) from (select * from fails order by {key}, reason limit 200)) preview from gate"""),
        "k5_status": sql(CATALOGUE, RESULTS, SHEET, FILES, f"""dec as (select coalesce(nullif("manualVisualDecision", ''), 'PENDING') d from sheet)""", f"""select (select count(*) from cat) "catalogueRows", (select count(*) from res) "acquisitionRows", {_counts('acquisitionStatusCounts', 'res', 'status')}, {_counts('reviewDecisionCounts', 'dec', 'd')},
          count(*) filter (d = {q(r.APPROVED)}) approved, count(*) filter (d in ({q(r.REVIEW)}, 'PENDING')) "manualReviewNeeded", count(*) filter (d = {q(r.REJECTED)}) "rejectedPendingRetry", (select count(*) from cat where "targetJpgPath" in (select path from files)) "finalFilesPresent" from dec"""),
        "k6_queue": sql(CATALOGUE, RESULTS, SHEET, f"""qq as (select c.n, {key}, coalesce(nullif(s."manualVisualDecision", ''), 'PENDING') decision from cat c left join sheet s using ({key}) where coalesce(s."manualVisualDecision", '') <> {q(r.APPROVED)}),
          pl as (select *, row_number() over (order by n) place, count(*) over () total from qq)""", f"select ((place - 1) // 100 + 1)::bigint page, place, ceil(total / 100)::bigint pages, {key}, decision from pl"),
    }
    return out
