"""Queries over records: canonical forms, similarity, identity, duplicates, sites, triage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from accordion.functions import normalize as N
from accordion.functions import similarity as S
from accordion.functions.numbers import exact_round, exact_round_sql
from accordion.operators import backtest, discovery, matching, resolve, similar_texts, triage
from accordion.plans import reconcile
from accordion.plans import tables as T
from accordion.plans.policy import RISK, WEIGHTS, Policy
from accordion.plans.store import written
from accordion.sources import readers, synth

# ---- pieces of SQL -------------------------------------------------------------------
_WORDS = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in {**N.SUFFIXES, **N.DIRECTIONS}.items()) + "}"
_CRED = "[" + ", ".join(f"'{c}'" for c in N.CREDENTIALS) + "]"


def _street(x: str) -> str:
    return f"array_to_string(list_transform(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''), lambda w: coalesce({_WORDS}[lower(trim(w, '.,'))], upper(w))), ' ')"


_UNITS = "[" + ", ".join(f"'{u}'" for u in N.UNIT_WORDS) + "]"
_strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _address(x: str) -> str:
    """Columns street, suite, city, state, zip5 and canonical from a table ``src`` with x."""
    begins = f"(list_contains({_UNITS}, lower(rtrim(w, '.'))) and regexp_matches(aw[i + 1], '^[\\w-]')) or (contains(w, '-') and list_contains({_UNITS}, lower(split_part(w, '-', 1))))"
    return f"""ad0 as (select *, string_split({x}, ',') as ap from src),
ad1 as (select *, {_strip('ap[-1]')} as al, {_strip('ap[-2]')} as ct, {_strip("array_to_string(ap[1:greatest(len(ap) - 2, 0)], ',')")} as st from ad0),
ad2 as (select *, left(al, 2) as sta, {_strip('substr(al, 3)')} as zp from ad1),
ad3 as (select * replace (case when len(ap) >= 3 then st else '' end as st), coalesce(len(ap) >= 3 and ct <> '' and regexp_matches(sta, '^[A-Za-z]{{2}}$') and (zp = '' or regexp_matches(zp, '^\\d{{5}}(-\\d{{4}})?$')), false) as fits,
    list_filter(regexp_split_to_array(regexp_replace(regexp_replace(st, ',', ', ', 'g'), '(\\w)#(\\w)', '\\1 # \\2', 'g'), '\\s+'), lambda w: w <> '') as aw from ad2),
ad4 as (select *, list_min(list_transform(aw, lambda w, i: case when {begins} then i end)) as ua from ad3),
ad5 as (select *, case when aw[ua] = '#' then '#' || regexp_extract(aw[ua + 1], '^[\\w-]+') when list_contains({_UNITS}, lower(rtrim(aw[ua], '.'))) then aw[ua] || ' ' || regexp_extract(aw[ua + 1], '^[\\w-]+') else aw[ua] end as unit,
    trim(array_to_string(aw[1:ua - 1], ' '), ' ,') as cutst from ad4),
ad6 as (select * exclude (ap, al, aw, ua) replace (case when fits then ct end as ct, case when fits then sta end as sta, case when fits then nullif(zp, '') end as zp, case when fits then unit end as unit) from ad5),
ad7 as (select *, nullif({_street(f"case when fits then case when unit is not null then cutst else st end else {x} end")}, '') as street, case when unit is not null then {_street('unit')} end as suite,
    upper(ct) as city, upper(sta) as state, nullif(substr(regexp_replace(zp, '\\D', '', 'g'), 1, 5), '') as zip5 from ad6),
ad as (select *, nullif(concat_ws(', ', street, city, nullif(concat_ws(' ', state, zip5), '')), '') as canonical from ad7)"""


def _extension(x: str) -> str:
    """A struct of the digits at the end, what stands before them, and the length of the mark there."""
    marks = " ".join(f"when ends_with(lower(r.b), '{m}') then {len(m)}" for m in N.EXTENSION_MARKS)
    one = f"list_transform([{_strip(x)}], lambda t: {{'d': regexp_extract(t, '\\d+$'), 't': t}})"
    two = f"list_transform({one}, lambda r: {{'d': r.d, 'b': {_strip('left(r.t, length(r.t) - length(r.d))')}}})"
    return f"list_transform({two}, lambda r: {{'d': r.d, 'b': r.b, 'm': case when length(r.d) between 1 and 6 then case {marks} else 0 end else 0 end}})[1]"


def _phone(x: str) -> str:
    number = f"list_transform([{_extension(x)}], lambda e: case when e.m > 0 then left(e.b, length(e.b) - e.m) else {x} end)[1]"
    digits = f"regexp_replace({number}, '\\D', '', 'g')"
    return f"list_transform([{digits}], lambda d: case when regexp_matches(d, '^1?([2-9]\\d{{2}}[2-9]\\d{{6}})$') then '+1' || right(d, 10) end)[1]"


def _name(x: str, out: str, src: str) -> str:
    """CTEs that add given, middle, family, credentials and canonical of name x in src."""
    mark = lambda t: f"upper(regexp_replace({t}, '[.\\s]', '', 'g'))"
    return f"""{out}0 as (select *, list_filter(regexp_split_to_array(case when contains({x}, ',') then split_part({x}, ',', 1) else {x} end, '\\s+'), lambda w: w <> '') as ws,
    case when contains({x}, ',') then regexp_replace({x}, '^[^,]*,', '') else '' end as tl from {src}),
{out}1 as (select *, coalesce(list_max(list_transform(ws, lambda w, i: case when not list_contains({_CRED}, {mark('w')}) then i end)), 0) as lst from {out}0),
{out}2 as (select *, ws[1:lst] as kept, list_concat(list_filter(list_transform(regexp_split_to_array(tl, '[,\\s]+'), lambda t: {mark('t')}), lambda t: list_contains({_CRED}, t)),
    list_reverse(list_transform(ws[lst + 1:], lambda t: {mark('t')}))) as creds from {out}1),
{out} as (select *, kept[1] as given, case when len(kept) > 2 then array_to_string(kept[2:len(kept) - 1], ' ') end as middle, case when len(kept) > 1 then kept[-1] end as family,
    case when len(kept) > 0 then coalesce(upper(case when len(kept) > 1 then kept[-1] end), '') || '|' || upper(kept[1]) end as canonical from {out}2)"""


def _practice(x: str) -> str:
    return f"nullif(trim(regexp_replace(regexp_replace(regexp_replace(upper({x}), '[.,]', ' ', 'g'), '\\b({'|'.join(N.COMPANY_WORDS)})\\b', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def _luhn(x: str) -> str:
    """Whether the digits of x pass the check."""
    return f"(list_sum(list_transform(range(1, length({x}) + 1), lambda i: case when (length({x}) - i) % 2 = 1 then (cast(substr({x}, i, 1) as int) * 2) // 10 + (cast(substr({x}, i, 1) as int) * 2) % 10 else cast(substr({x}, i, 1) as int) end)) % 10 = 0)"


def _soundex(x: str) -> str:
    code = "translate(c, 'BFPVCGJKQSXZDTLMNRAEIOUY', '111122222222334556000000')"
    letters = f"upper(regexp_replace(coalesce({x}, ''), '[^A-Za-z]', '', 'g'))"
    kept = f"list_filter(string_split({letters}, ''), lambda c, i: i = 1 or c not in ('H', 'W'))"
    codes = f"list_transform({kept}, lambda c: {code.replace('c, ', 'c, ')})"
    first = f"case when left({letters}, 1) in ('H', 'W') then '' else translate(left({letters}, 1), 'BFPVCGJKQSXZDTLMNRAEIOUY', '111122222222334556000000') end"
    seq = f"list_concat([{first}], {codes}[2:])"
    tail = f"list_filter(list_transform({seq}, lambda c, i: case when i > 1 and c <> '0' and c <> coalesce({seq}[i - 1], '') then c else '' end), lambda c: c <> '')"
    return f"case when {letters} = '' then '' else rpad(left(left({letters}, 1) || array_to_string({tail}, ''), 4), 4, '0') end"


def _grams(x: str) -> str:
    return f"list_distinct(list_transform(range(1, length({x}) + 2), lambda i: substr('  ' || lower({x}) || ' ', i, 3)))"


def _similar(a: str, b: str) -> str:
    return f"case when {a} is null or {b} is null or {a} = '' or {b} = '' then 0.0 when {a} = {b} then 1.0 else len(list_intersect({_grams(a)}, {_grams(b)})) / len(list_distinct(list_concat({_grams(a)}, {_grams(b)}))) end"


# ---- canonical forms -----------------------------------------------------------------
def normalize_phones(spark, sf):
    d = T.directory(spark, sf)
    return d.select("provider_id", N.phone(F.col("phone")).alias("phone"), N.phone_extension(F.col("phone")).alias("extension"))


def normalize_addresses(spark, sf):
    return T.directory(spark, sf).select("provider_id", N.address(F.col("address")).alias("a")).select("provider_id", "a.*")


def normalize_names(spark, sf):
    return T.directory(spark, sf).select("provider_id", N.name(F.col("provider_name")).alias("n")).select("provider_id", "n.given", "n.middle", "n.family", F.array_join("n.credentials", ",").alias("credentials"), "n.canonical")


def normalize_practices(spark, sf):
    return T.directory(spark, sf).select("provider_id", N.practice_name(F.col("practice_name")).alias("practice"))


def normalize_states(spark, sf):
    o = T.read(spark, sf, "orders")
    raw = F.get(F.array(*map(F.lit, ["A", " Active ", "TRUE", "1", "no", "Retired", "I", "x", ""])), F.pmod("o_orderkey", F.lit(9)).cast("int"))
    return o.select("o_orderkey", N.active(raw).alias("active"), N.status_label(raw).alias("label"))


def normalize_dates(spark, sf):
    o = T.read(spark, sf, "orders")
    given = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.lit("soon"))
    return o.select("o_orderkey", N.source_date(given).cast("string").alias("day"))


def normalize_zips(spark, sf):
    c = T.read(spark, sf, "customer")
    given = F.concat(F.lit("Z-"), F.lpad((F.col("c_custkey") * 7919 % 1000000000).cast("string"), 9, "0"))
    given = F.when(F.col("c_custkey") % 5 == 0, F.substring(given, 1, 6)).when(F.col("c_custkey") % 7 == 0, F.concat(F.substring(given, 1, 7), F.lit("0000"))).otherwise(given)
    return c.select("c_custkey", N.zip5(given).alias("zip5"), N.zip_display(given).alias("shown"))


def specialty_codes(spark, sf):
    """Label to code (the first code with it) and back, with a table over the seed."""
    d = T.read(spark, sf, "part").select(F.concat(F.lit("X"), F.lpad((F.col("p_partkey") % 40).cast("string"), 3, "0")).alias("code"), F.col("p_brand").alias("specialty"), F.lit(1).alias("rank"), F.col("p_partkey").alias("ord"))
    merged = readers.merged_specialties(d)
    first = merged.groupBy(F.lower("specialty").alias("label")).agg(F.min("code").alias("code"))
    asked = T.read(spark, sf, "part").select("p_partkey", F.upper("p_brand").alias("asked"))
    out = asked.join(F.broadcast(first), F.lower(F.trim("asked")) == F.col("label"), "left")  # at most one row per code
    return out.select("p_partkey", "code").join(F.broadcast(merged), "code", "left").select("p_partkey", "code", F.coalesce("specialty", "code").alias("shown"))


def page_domains(spark, sf):
    return T.read(spark, sf, "pages").select("page_id", N.domain(F.col("url")).alias("domain"), N.domain(F.regexp_replace("url", "^https?://", "WWW.")).alias("bare"))


def clean_texts(spark, sf):
    d = T.read(spark, sf, "documents")
    return d.select("doc_id", N.clean_text("text").alias("cleaned"), N.slug(F.col("text")).alias("slug"), N.snapshot_hash(F.col("text")).alias("hash"))


def npi_checks(spark, sf):
    c = T.read(spark, sf, "customer")
    nine = F.concat(F.lit("1"), F.lpad((F.col("c_custkey") * 48611 % 100000000).cast("string"), 8, "0"))
    ten = F.concat(nine, (F.col("c_custkey") % 10).cast("string"))
    return c.select("c_custkey", N.valid_npi(ten).alias("valid"), N.with_check_digit(nine).alias("npi"), N.valid_npi(F.lit("12345")).alias("short"))


# ---- similarity ----------------------------------------------------------------------
def soundex_codes(spark, sf):
    return T.read(spark, sf, "part").select("p_partkey", S.soundex(F.substring_index("p_name", " ", -1)).alias("last"), S.soundex(F.col("p_name")).alias("whole"), S.soundex(F.col("p_type")).alias("kind"))


def trigram_pairs(spark, sf):
    """Similar texts, within blocks of language and first letters; whole texts are compared."""
    # Letter by letter, as in SQL: no letter that becomes two, no other sigma at a word's end.
    low = lambda c: F.lower(F.when(c.contains("İ") | c.contains("Σ"), F.translate(c, "İΣ", "iσ")).otherwise(c))
    text = F.col("text")
    block = F.concat("lang", F.lit("|"), low(F.substring(text, 1, 8)))
    return similar_texts.similar_pairs(T.read(spark, sf, "documents").select("doc_id", block.alias("block"), F.concat(F.lit("  "), low(text), F.lit(" ")).alias("text")))


_GEO = "select vec_id, label, embedding[1] * 2 + 26 as lat, embedding[2] * 2 - 81 as lon from embeddings"


def geo_distances(spark, sf):
    """Each point and the next of its label."""
    e = T.read(spark, sf, "embeddings").select("vec_id", "label", (F.get("embedding", F.lit(0)).cast("double") * 2 + 26).alias("lat"), (F.get("embedding", F.lit(1)).cast("double") * 2 - 81).alias("lon"))
    w = Window.partitionBy("label").orderBy("vec_id")
    rows = e.withColumns({"lat2": F.lead("lat").over(w), "lon2": F.lead("lon").over(w)}).where("lat2 is not null")
    km = S.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return rows.select("vec_id", F.round(km, 4).alias("km"), F.round(S.site_similarity(km / 40), 4).alias("similarity"))


def freshness(spark, sf):
    o = T.read(spark, sf, "orders")
    return o.select("o_orderkey", F.round(T.POLICY.freshness_of(F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate"))), 6).alias("freshness"))


def policy_lookup(spark, sf):
    a = T.assertions(spark, sf)
    return a.groupBy("field", "source_class").agg(F.count("*").alias("n")).select("field", "source_class", "n", T.POLICY.weight_of(F.col("field"), F.col("source_class")).alias("weight"), T.POLICY.risk_of(F.col("field")).alias("risk"), T.POLICY.risk_of(F.lit("unknown")).alias("default_risk"))


# ---- identity ------------------------------------------------------------------------
def _registry(spark, sf):
    """Of each eleventh customer's name a few entries: some persons, some firms."""
    d = T.directory(spark, sf)
    n = N.name(F.col("provider_name"))
    k = F.col("_ord")
    firm = k % 9 == 0
    base = d.select("provider_id", "npi", "practice_name", n.alias("n"), "_ord").where((k % 4 != 0) | (k % 6 == 0))
    npi = F.when(k % 6 == 0, N.with_check_digit(F.concat(F.lit("19"), F.lpad(k.cast("string"), 7, "0")))).otherwise(F.col("npi"))
    given = F.when(k % 10 == 3, F.lit("Zoe")).otherwise(F.col("n.given"))
    family = F.when(k % 13 == 5, F.lit("Other")).otherwise(F.col("n.family"))
    return base.select(npi.alias("npi"), F.when(~firm, given).alias("first_name"), F.when(~firm, family).alias("last_name"), F.when(firm, F.col("practice_name")).alias("organization_name"), F.coalesce(F.when(firm, F.col("practice_name")), F.concat_ws(" ", given, family)).alias("display_name"), "_ord").where("npi is not null")


def resolve_identity(spark, sf):
    d = T.directory(spark, sf).withColumn("provider_name", F.when(F.col("_ord") % 9 != 0, F.col("provider_name")))
    return resolve.resolve(d, _registry(spark, sf))


_NPI_OF = lambda nine: f"list_filter(list_transform(range(0, 10), lambda q: {nine} || cast(q as varchar)), lambda z: {_luhn('(' + chr(39) + '80840' + chr(39) + ' || z)')})[1]"

_RESOLVE = f"""{T.DIRECTORY}, {_name('provider_name', 'dn', 'dir')},
reg0 as (select case when _ord % 6 = 0 then {_NPI_OF("'19' || lpad(cast(_ord as varchar), 7, '0')")} else npi end as npi, _ord % 9 = 0 as firm,
    case when _ord % 10 = 3 then 'Zoe' else given end as g, case when _ord % 13 = 5 then 'Other' else family end as f, practice_name, _ord from dn where _ord % 4 <> 0 or _ord % 6 = 0),
reg1 as (select npi, case when not firm then g end as first_name, case when not firm then f end as last_name, case when firm then practice_name end as organization_name,
    coalesce(case when firm then practice_name end, concat_ws(' ', g, f)) as display_name, _ord from reg0 where npi is not null),
reg2 as (select *, case when organization_name is null then concat_ws(' ', first_name, last_name) end as full_name from reg1 qualify row_number() over (partition by npi order by _ord) = 1),
{_name('full_name', 'rn', 'reg2')},
p as (select npi as p_npi, canonical as p_c, family as p_f, {_practice('organization_name')} as p_org, display_name, _ord as p_ord,
    case when organization_name is not null then 'org_' || trim(regexp_replace(lower(organization_name), '[^a-z0-9]+', '_', 'g'), '_')
    else trim(regexp_replace(lower(concat_ws('_', coalesce(last_name, ''), coalesce(first_name, ''))), '[^a-z0-9]+', '_', 'g'), '_') end as search from rn),
dir2 as (select provider_id, case when _ord % 9 <> 0 then provider_name end as pn, npi as r_npi, practice_name, _ord from dir),
{_name('pn', 'qn', 'dir2')},
r as (select provider_id, r_npi, canonical as r_c, family as r_f, {_practice('practice_name')} as r_practice,
    case when family is not null then trim(regexp_replace(lower(concat_ws('_', family, given)), '[^a-z0-9]+', '_', 'g'), '_')
    else 'org_' || trim(regexp_replace(lower(practice_name), '[^a-z0-9]+', '_', 'g'), '_') end as search from qn),
ag as (select r.*, p.* exclude (search), case when r_c is not null and p_c is not null then case when r_c = p_c then 1.0 when upper(r_f) = upper(p_f) then 0.6 else 0.0 end
    when contains(r_practice, p_org) or contains(p_org, r_practice) then 0.8 else 0.0 end as s from r left join p on case when r_npi is not null then r_npi = p_npi else r.search = p.search end),
byid as (select provider_id, case when p_npi is null then 'unresolved' when s < 0.5 then 'mismatch' when not {_luhn("('80840' || r_npi)")} then 'bad_checkdigit' else 'validated' end as status,
    r_npi as npi, case when p_npi is null then 0.0 else s end as agreement, display_name from ag where r_npi is not null),
cold as (select *, row_number() over (partition by provider_id order by p_ord, p_npi) as a from ag where r_npi is null),
top as (select *, lead(sc) over (partition by provider_id order by sc desc nulls last, p_ord, p_npi) as nxt, row_number() over (partition by provider_id order by sc desc nulls last, p_ord, p_npi) as k
    from (select *, case when p_npi is not null then s end as sc from cold where a <= 20)),
res as (select provider_id, status, npi, agreement, 'NPI ' || npi || case status when 'unresolved' then ' not found in NPPES.' when 'mismatch' then ' resolves to a different entity (''' || coalesce(display_name, '') || '''); routing to repair, not update.'
    when 'bad_checkdigit' then ' fails its check digit; proceeding but flagged for repair.' else ' validated and matched.' end as note from byid
  union all select provider_id, case when sc >= 0.6 and not coalesce(nxt >= sc - 0.05, false) then 'resolved_by_search' else 'unresolved' end,
    case when sc >= 0.6 and not coalesce(nxt >= sc - 0.05, false) then p_npi end, case when sc >= 0.6 then sc else 0.0 end,
    case when sc >= 0.6 and coalesce(nxt >= sc - 0.05, false) then 'Multiple equally plausible NPPES matches; routing to human review.'
    when sc >= 0.6 then 'NPI ' || p_npi || ' recovered by name/org search (agreement ' || printf('%.2f', sc) || ').' else 'No confident NPPES match; record quarantined for human review.' end from top where k = 1)"""


# ---- duplicates ----------------------------------------------------------------------
def _records(spark, sf):
    """The directory, and of each tenth record a second one: the name in capitals, the same
    place, and the phone missing from every other."""
    d = T.directory(spark, sf).select("provider_id", F.when(F.col("_ord") % 5 == 0, F.col("npi")).alias("npi"), "provider_name", "address", "phone", "_ord")
    again = d.where("_ord % 10 = 3").select(F.concat("provider_id", F.lit("-2")).alias("provider_id"), "npi", F.upper("provider_name").alias("provider_name"), "address", F.when(F.col("_ord") % 20 == 3, F.col("phone")).alias("phone"))
    return d.drop("_ord").unionByName(again)


def block_keys(spark, sf):
    return matching.block_keys(_records(spark, sf)).select("provider_id", "block")


def duplicate_pairs(spark, sf):
    pairs = matching.scored_pairs(matching.candidate_pairs(matching.block_keys(_records(spark, sf))))
    return pairs.where("score >= 0.6")


def duplicate_clusters(spark, sf):
    return matching.clusters(_records(spark, sf)).withColumn("provider_ids", F.array_join("provider_ids", ","))


_BLOCKS = f"""{T.DIRECTORY}, dirx as (select provider_id, case when _ord % 5 = 0 then npi end as npi, provider_name, address, phone from dir
    union all select provider_id || '-2', case when _ord % 5 = 0 then npi end, upper(provider_name), address, case when _ord % 20 = 3 then phone end from dir where _ord % 10 = 3),
{_name('provider_name', 'nm', 'dirx')}, src as (select provider_id, npi, canonical as name, family as fam, address, phone from nm), {_address('address')},
m as (select provider_id, npi, name, fam, canonical as place, zip5, {_phone('phone')} as phone from ad),
bl as (select * from (select *, 'npi:' || npi as block from m union all select *, 'sx:' || {_soundex('fam')} || ':' || coalesce(zip5, '?????') as block from m where name is not null) where block is not null)"""

_PAIRS = f"""{_BLOCKS},
pr as (select distinct a.provider_id as a, b.provider_id as b, a.npi as npi_a, b.npi as npi_b, a.name as name_a, b.name as name_b, a.place as place_a, b.place as place_b, a.phone as phone_a, b.phone as phone_b
    from bl a join bl b on a.block = b.block and a.provider_id < b.provider_id),
sm as (select *, {_similar('name_a', 'name_b')} as ns, {_similar('place_a', 'place_b')} as ps, case when phone_a = phone_b then 1.0 else 0.0 end as fs from pr),
sc as (select a, b, npi_a = npi_b as same, {exact_round_sql('0.55 * ns + 0.30 * ps + 0.15 * fs', 4)} as score, {exact_round_sql('ns', 2)} as n2, {exact_round_sql('ps', 2)} as p2, fs, npi_a from sm),
scored as (select a as provider_id_a, b as provider_id_b, case when same then 1.0 else score end as score,
    case when same then 'identical NPI ' || npi_a else 'name=' || printf('%.2f', n2) || ', address=' || printf('%.2f', p2) || ', phone=' || printf('%.2f', fs) end as reason from sc)"""

_CLUSTERS = f"""with recursive {_PAIRS}, e as (select provider_id_a as u, provider_id_b as v from scored where score >= 0.82 union all select provider_id_b, provider_id_a from scored where score >= 0.82),
reach as (select u as node, u as root from e union select e.v, reach.root from reach join e on e.u = reach.node),
lab as (select node, min(root) as component from reach group by node),
ids as (select component, string_agg(node, ',' order by node) as provider_ids, arg_min(npi, node) filter (where npi is not null) as npi from lab join dirx on node = provider_id group by component),
why as (select component, max(score) as match_score, string_agg(distinct reason, '; ' order by reason) as reason from scored join lab on provider_id_a = node where score >= 0.82 group by component)
select ids.component as cluster_id, provider_ids, npi, match_score, reason from ids join why on ids.component = why.component"""


def moves(spark, sf):
    """Records whose address now and a neighbour's differ in more than form."""
    d = T.directory(spark, sf)
    w = Window.partitionBy((F.col("_ord") % 97).alias("g")).orderBy("_ord")
    rows = d.withColumn("next", F.lead("address").over(w))
    return rows.select("provider_id", F.coalesce(N.address(F.col("address"))["canonical"] != N.address(F.col("next"))["canonical"], F.lit(False)).alias("moved"))


# ---- sites ---------------------------------------------------------------------------
_AGG = [f"th{x}.example.com" for x in ("thre", "ere", "an")]


def site_scores(spark, sf):
    rows = _scored_sites(spark, sf)
    return rows.select("provider_id", "pos", "domain", F.array_join(F.transform("evidence", lambda e: e["label"]), ",").alias("evidence"), "score", "status")


def _scored_sites(spark, sf):
    d = T.directory(spark, sf)
    d = d.select("provider_id", "_ord", F.array("practice_name").alias("practices"), F.array("provider_name").alias("names"), F.array("npi").alias("npis"), F.array("phone").alias("phones"), F.array("address").alias("addresses"), F.array("provider_name").alias("mentions"))
    p = T.read(spark, sf, "pages")
    k = F.col("page_id")
    # A page is a candidate of the record with its number, and tells part of what it holds.
    about = T.directory(spark, sf).select(F.col("_ord").alias("k"), "provider_name", "practice_name", "npi", "phone", "address")
    pages = p.join(about, k == F.col("k")).select(
        k.cast("string").alias("provider_id"), "url", k.alias("pos"),
        F.when(k % 2 == 0, F.upper("practice_name")).alias("practice_name"), F.when(k % 3 == 0, F.array(F.lower("provider_name"))).otherwise(F.array().cast("array<string>")).alias("provider_names"),
        F.when(k % 4 == 0, F.array("npi")).otherwise(F.array().cast("array<string>")).alias("npis"), F.when(k % 5 != 0, F.col("phone")).alias("phone"), F.when(k % 7 != 0, F.col("address")).alias("address"),
        F.col("html").alias("page_text"),
    )
    return discovery.score(pages, discovery.targets(d), _AGG)


def best_sites(spark, sf):
    hosts = _scored_sites(spark, sf).withColumn("provider_id", F.pmod(F.col("pos"), F.lit(40)).cast("string"))
    return discovery.best_site(hosts).select("provider_id", "pos", "score", "status")


def site_assertions(spark, sf):
    rows = discovery.to_assertions(discovery.best_site(_scored_sites(spark, sf)))
    return rows.select("provider_id", "field", "value", "raw_value", "source_class")


_SITES = f"""{T.DIRECTORY}, {_name('provider_name', 'sn', 'dir')}, src as (select * exclude (canonical), canonical as person from sn), {_address('address')},
sd as (select page_id as pos, url, html, provider_id, provider_name, practice_name, npi, phone, address, person, canonical as place from pages join ad on page_id = _ord),
low as (select *, lower(provider_name) as lname from sd), {_name('lname', 'ln', '(select * exclude (fits, st, ct, sta, zp, unit, cutst, street, suite, city, state, zip5, ws, tl, lst, kept, creds, given, middle, family) from (select *, 0 as fits, 0 as st, 0 as ct, 0 as sta, 0 as zp, 0 as unit, 0 as cutst, 0 as street, 0 as suite, 0 as city, 0 as state, 0 as zip5, 0 as ws, 0 as tl, 0 as lst, 0 as kept, 0 as creds, 0 as given, 0 as middle, 0 as family from low))')},
dm as (select *, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') as domain,
    trim(regexp_replace(upper(replace(html, 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')) as txt,
    trim(regexp_replace(upper(provider_name), '[^A-Z0-9]+', ' ', 'g')) as needle from ln),
ev as (select *, domain in ({", ".join(f"'{a}'" for a in _AGG)}) as e1, pos % 2 = 0 and {_practice('practice_name')} is not null as e3, pos % 3 = 0 and coalesce(canonical = person, false) as e4,
    pos % 4 = 0 and npi is not null as e5, pos % 5 <> 0 and {_phone('phone')} is not null as e6, pos % 7 <> 0 and place is not null as e7, contains(txt, needle) as e8 from dm),
sites as (select provider_id, pos, domain, phone, address, practice_name, concat_ws(',', case when e1 then 'aggregator_penalty' else 'own_domain' end, case when e3 then 'practice_name' end, case when e4 then 'provider_roster' end,
    case when e5 then 'npi_on_page' end, case when e6 then 'phone_match' end, case when e7 then 'address_match' end, case when e8 then 'page_text_match' end) as evidence,
    {exact_round_sql("least(greatest(cast(case when e1 then -0.35 else 0.05 end as double) + case when e3 then 0.20::double else 0 end + case when e4 then 0.20::double else 0 end + case when e5 then 0.15::double else 0 end + case when e6 then 0.18::double else 0 end + case when e7 then 0.20::double else 0 end + case when e8 then 0.07::double else 0 end, 0), 1)", 4)} as score, place from ev),
st as (select *, case when score >= 0.72 then 'verified_official_site' when score >= 0.55 then 'probable_site' else 'ambiguous_or_rejected' end as status from sites)"""


# ---- triage, snapshots, generator -----------------------------------------------------
def triage_scores(spark, sf):
    e = T.read(spark, sf, "events")
    hard = e.groupBy(F.col("user_id").cast("string").alias("provider_id")).agg(F.round(F.avg((F.col("event_type") == "error").cast("double")), 6).alias("value"))
    c = T.read(spark, sf, "customer")
    weight = c.where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("provider_id"), (F.col("c_acctbal") / 9000).alias("value"))
    rows = triage.risk(T.directory(spark, sf), T.AS_OF, hard, weight)
    return rows.select("provider_id", "score", F.col("staleness_days").cast("long").alias("staleness_days"), F.array_join("reasons", "; ").alias("reasons"))


def triage_top(spark, sf):
    return triage.verify_queue(triage_scores(spark, sf).select("provider_id", "score"), top=25)


_TRIAGE = f"""{T.DIRECTORY}, hs as (select cast(user_id as varchar) as provider_id, round(avg(case when event_type = 'error' then 1.0 else 0.0 end), 6) as value from events group by 1),
im as (select cast(c_custkey as varchar) as provider_id, c_acctbal / 9000 as value from customer where c_acctbal > 0),
ts as (select dir.provider_id, phone, last_verified_date as lv, case when last_verified_date is null then 1000000 else greatest(date_diff('day', last_verified_date, date '2001-08-02'), 0) end as days,
    coalesce(hs.value, 0) as h, coalesce(im.value, 0.5) as i from dir left join hs on hs.provider_id = dir.provider_id left join im on im.provider_id = dir.provider_id),
tr as (select provider_id, {exact_round_sql("least(0.5::double * case when lv is null then 1.0::double else least(days::double / 90 / 24, 1) end + 0.2::double * case when phone <> '' then 0.6::double else 0.3::double end + 0.2::double * least(greatest(h, 0), 1) + 0.1::double * least(greatest(i, 0), 1), 1)", 4)} as score,
    days as staleness_days, concat_ws('; ', case when lv is null then 'never verified' when days > 90 then cast(days as varchar) || 'd since last verify (> 90d window)' end, case when h > 0 then 'hard signal (deactivation / diff / bounce-back)' end) as reasons from ts)"""


def _snapshots(spark, sf):
    o = T.read(spark, sf, "orders")

    def at(rows):
        row = F.max_by(F.struct("o_orderpriority", "o_orderkey", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey"))
        last = rows.groupBy(F.col("o_custkey").cast("string").alias("npi")).agg(row.alias("x"))
        return last.select("npi", F.col("x.o_orderpriority").alias("address"), F.nullif((F.col("x.o_orderkey") % 3).cast("string"), F.lit("0")).alias("phone"), F.when(F.col("x.o_orderstatus") == "F", "A").otherwise("I").alias("status"))

    return at(o.where("o_orderdate < timestamp '1998-06-01'")), at(o)


def snapshot_cases(spark, sf):
    return backtest.build_cases(*_snapshots(spark, sf))


_SNAP = lambda where: f"select cast(o_custkey as varchar) as npi, arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) as address, nullif(cast(max_by(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) % 3 as varchar), '0') as phone, case when arg_max(o_orderstatus, struct_pack(a := o_orderdate, b := o_orderkey)) = 'F' then 'A' else 'I' end as status from orders {where} group by 1"


def synthetic_world(spark, sf):
    ids = T.read(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return synth.snapshot_world(ids, seed=7)


_DRAW = lambda salt: f"(cast('0x' || substr(md5(cast(c_custkey as varchar) || ':{salt}:7'), 1, 8) as bigint) / 4294967296.0)"
_PICK = lambda salt, values: f"[{', '.join(chr(39) + v + chr(39) for v in values)}][cast(floor({_DRAW(salt)} * {len(values)}) as int) + 1]"
_PLACE = lambda s: f"cast(cast(floor({_DRAW('number' + s)} * 9950 + 50) as bigint) as varchar) || ' ' || {_PICK('street' + s, synth.STREETS)} || ', ' || {_PICK('city' + s, synth.CITIES)}"
_TEL = lambda s: f"'518-555-' || cast(cast(floor({_DRAW('phone' + s)} * 9000 + 1000) as bigint) as varchar)"


def _world() -> str:
    edges, edge = [], 0.0
    for name, share in synth.SCENARIOS[:-1]:
        edge = round(edge + share, 10)
        edges.append(f"when {_DRAW('scenario')} < {edge} then '{name}'")
    return f"""world as (select 'SY_' || cast(c_custkey as varchar) as provider_id, {_NPI_OF("('1' || lpad(cast((c_custkey * 7368787 + 7) % 100000000 as varchar), 8, '0'))")} as npi, {_PICK('specialty', sorted(N.SPECIALTY_SEED))} as code,
    case {" ".join(edges)} else '{synth.SCENARIOS[-1][0]}' end as scenario, {_PLACE('a')} as old_address, {_TEL('a')} as old_phone, {_PLACE('b')} as new_address, {_TEL('b')} as new_phone,
    case when {_DRAW('noiseaddress')} < {synth.NOISE} then {_PLACE('c')} else {_PLACE('b')} end as true_address, case when {_DRAW('noisephone')} < {synth.NOISE} then {_TEL('c')} else {_TEL('b')} end as true_phone from customer)"""


def scale_backtest(spark, sf):
    """The whole engine on a generated world of as many records as there are customers."""
    return scale_report(synthetic_world(spark, sf)).select("records", "true_changes", "detected_changes", "correct_detections", "auto_updates", "correct_auto_updates", "routing_correct")


def scale_report(world):
    """The backtest's row for a world; its recommendations go through every step."""
    world = written(world)
    rows = synth.source_rows(world)
    done = reconcile.reconcile(reconcile.Inputs(rows["directory"], rows["registry"], rows["claims"], rows["web"], specialties=readers.specialties(world.sparkSession)), Policy(as_of=T.AS_OF))
    return backtest.report(written(done.recommendations), rows["truth"], rows["expected"])


#: What a right engine makes of each scenario: all real changes are found, a change is right
#: unless the truth came out otherwise, and those of two agreeing sources and more go through.
_SCALE = """ch as (select scenario, 'phone' as field, old_phone as was, new_phone as said, true_phone as is_true from world where scenario in ('phone', 'move')
    union all select scenario, 'address', old_address, new_address, true_address from world where scenario = 'move'
    union all select scenario, 'address', old_address, new_address, new_address from world where scenario = 'conflict'
    union all select scenario, 'active', 'Active', 'Inactive', 'Inactive' from world where scenario = 'deactivation'),
rt as (select count(*) as records, count(*) filter (where scenario = 'no_change' or scenario = 'deactivation' or scenario = 'phone' and old_phone <> new_phone
    or scenario = 'move' and (old_phone <> new_phone or old_address <> new_address) or scenario = 'conflict' and old_address <> new_address) as routing_correct from world)"""


def newest_by_key(spark, sf):
    """Each user's newest event of each type that is not older than a week (a cache with a
    time to live), and its property."""
    e = T.read(spark, sf, "events").select(F.concat_ws(":", "user_id", "event_type").alias("key"), F.struct("event_id", "value", "props").alias("payload"), F.col("ts").alias("fetched_at"), "event_id")
    fresh = readers.fresh_cache(e.withColumn("fetched_at", F.col("fetched_at") + F.make_dt_interval(secs=F.col("event_id") / 10**7)), "2024-01-31 00:00:00", 7 * 86400)
    return fresh.select("key", "payload.event_id", "payload.value", F.get_json_object("payload.props", "$.k").alias("k"))


def source_sets(spark, sf):
    """Per record: kinds of source for its best status against those of the others."""
    a = T.assertions(spark, sf)
    sets = a.groupBy("provider_id").agg(F.collect_set(F.when(F.col("value") == "F", F.col("source_class"))).alias("f"), F.collect_set(F.when(F.col("value") != "F", F.col("source_class"))).alias("o"))
    join = lambda c: F.array_join(F.sort_array(c), ",")
    return sets.select("provider_id", join(F.array_except("f", "o")).alias("only_f"), join(F.array_intersect("f", "o")).alias("both"), join(F.array_union("f", "o")).alias("any"))


def search_terms(spark, sf):
    """The distinct clues of a record in the order first seen."""
    d = T.directory(spark, sf)
    terms = F.array_distinct(F.filter(F.array("provider_name", "practice_name", "phone", N.state_of(F.col("address")), "specialty", N.state_of(F.col("address"))), lambda x: ~N.blank(x)))
    return d.select("provider_id", F.array_join(terms, " / ").alias("terms"))


def effective_rows(spark, sf):
    """Records as long rows of field, canonical and given value."""
    d = T.directory(spark, sf)
    active = F.when(F.col("active"), "Active").otherwise("Inactive")
    pairs = {"provider_name": F.col("provider_name"), "address": F.col("address"), "phone": F.col("phone"), "active": active, "practice_name": F.col("practice_name")}
    rows = d.select("provider_id", F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("raw_cur")) for k, v in pairs.items()])).alias("x")).select("provider_id", "x.*")
    return rows.withColumn("cur", N.of_field(F.col("field"), F.col("raw_cur")))


QUERIES = {
    "normalize_phones": (normalize_phones, f"with {T.DIRECTORY} select provider_id, {_phone('phone')} as phone, list_transform([{_extension('phone')}], lambda e: case when e.m > 0 then e.d end)[1] as extension from dir"),
    "normalize_addresses": (normalize_addresses, f"with {T.DIRECTORY}, src as (select * from dir), {_address('address')} select provider_id, street, suite, city, state, zip5, canonical from ad"),
    "normalize_names": (normalize_names, f"with {T.DIRECTORY}, {_name('provider_name', 'nm', 'dir')} select provider_id, given, middle, family, array_to_string(list_transform(list_filter(list_transform(creds, lambda c, i: {{'c': c, 'f': list_position(creds, c) = i}}), lambda x: x.f), lambda x: x.c), ',') as credentials, canonical from nm"),
    "normalize_practices": (normalize_practices, f"with {T.DIRECTORY} select provider_id, {_practice('practice_name')} as practice from dir"),
    "normalize_states": (normalize_states, """select o_orderkey, case when lower(trim(r)) in ('a', 'active', 'true', '1', 'yes') then 'active' when lower(trim(r)) in ('i', 'inactive', 'deactivated', 'false', '0', 'no', 'retired') then 'inactive' end as active,
case when upper(r) = 'A' then 'Active' when upper(r) = 'I' then 'Deactivated' else r end as label from (select o_orderkey, ['A', ' Active ', 'TRUE', '1', 'no', 'Retired', 'I', 'x', ''][cast(o_orderkey % 9 + 1 as int)] as r from orders)"""),
    "normalize_dates": (normalize_dates, "select o_orderkey, case when o_orderkey % 3 < 2 then cast(cast(o_orderdate as date) as varchar) end as day from orders"),
    "normalize_zips": (normalize_zips, """with z as (select c_custkey, 'Z-' || lpad(cast(c_custkey * 7919 % 1000000000 as varchar), 9, '0') as g from customer),
y as (select c_custkey, regexp_replace(case when c_custkey % 5 = 0 then substr(g, 1, 6) when c_custkey % 7 = 0 then substr(g, 1, 7) || '0000' else g end, '\\D', '', 'g') as d from z)
select c_custkey, nullif(substr(d, 1, 5), '') as zip5, case when length(d) >= 9 and substr(d, 6, 4) <> '0000' then substr(d, 1, 5) || '-' || substr(d, 6, 4) else nullif(substr(d, 1, 5), '') end as shown from y"""),
    "specialty_codes": (specialty_codes, """with m as (select 'X' || lpad(cast(p_partkey % 40 as varchar), 3, '0') as code, arg_max(p_brand, p_partkey) as specialty from part group by 1),
f as (select lower(specialty) as label, min(code) as code from m group by 1) select p_partkey, f.code, coalesce(specialty, f.code) as shown from part left join f on lower(p_brand) = label left join m on m.code = f.code"""),
    "page_domains": (page_domains, "select page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') as domain, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^$', '') as bare from pages"),
    "clean_texts": (clean_texts, "select doc_id, nullif(trim(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')), '') as cleaned, trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') as slug, 'sha256:' || substr(sha256(text), 1, 32) as hash from documents"),
    "npi_checks": (npi_checks, f"with n as (select c_custkey, '1' || lpad(cast(c_custkey * 48611 % 100000000 as varchar), 8, '0') as nine from customer) select c_custkey, {_luhn("('80840' || nine || cast(c_custkey % 10 as varchar))")} as valid, {_NPI_OF('nine')} as npi, false as short from n"),
    "soundex_codes": (soundex_codes, f"select p_partkey, {_soundex('''split_part(p_name, ' ', -1)''')} as last, {_soundex('p_name')} as whole, {_soundex('p_type')} as kind from part"),
    "trigram_pairs": (trigram_pairs, f"""with d as (select doc_id, lang || '|' || lower(substr(text, 1, 8)) as block, {_grams('text')} as g from documents)
select a.doc_id as id_a, b.doc_id as id_b, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 4) as similarity from d a join d b on a.block = b.block and a.doc_id < b.doc_id
where round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 4) >= 0.82"""),
    "geo_distances": (geo_distances, """with g as (select vec_id, label, cast(embedding[1] as double) * 2 + 26 as lat, cast(embedding[2] as double) * 2 - 81 as lon from embeddings),
n as (select *, lead(lat) over (partition by label order by vec_id) as lat2, lead(lon) over (partition by label order by vec_id) as lon2 from g),
k as (select vec_id, 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon) / 2), 2))) as km from n where lat2 is not null)
select vec_id, round(km, 4) as km, round(case when km / 40 <= 0.15 then 1.0 else greatest(1 - km / 40 / 2, 0) end, 4) as similarity from k"""),
    "freshness": (freshness, "select o_orderkey, round(case when o_orderkey % 5 = 0 then 1.0 else greatest(pow(0.5, greatest(date_diff('day', cast(o_orderdate as date), date '2001-08-02'), 0) / 540.0), 0.3) end, 6) as freshness from orders"),
    "policy_lookup": (policy_lookup, f"""with {T.ASSERTIONS}, w as (select * from (values {", ".join(f"('{f}', '{c}', {w})" for f, row in WEIGHTS.items() for c, w in row.items())}) t(field, source_class, weight)),
rk as (select * from (values {", ".join(f"('{f}', '{r}')" for f, r in RISK.items())}) t(field, risk)), n as (select field, source_class, count(*) as n from a group by all)
select n.field, n.source_class, n, coalesce(weight, 0.40) as weight, coalesce(risk, 'medium') as risk, 'medium' as default_risk from n left join w on w.field = n.field and w.source_class = n.source_class left join rk on rk.field = n.field"""),
    "resolve_identity": (resolve_identity, f"with {_RESOLVE} select provider_id, status, npi, agreement, note, status in ('validated', 'bad_checkdigit', 'resolved_by_search') as usable from res"),
    "block_keys": (block_keys, f"with {_BLOCKS} select provider_id, block from bl"),
    "duplicate_pairs": (duplicate_pairs, f"with {_PAIRS} select * from scored where score >= 0.6"),
    "duplicate_clusters": (duplicate_clusters, _CLUSTERS),
    "moves": (moves, f"with {T.DIRECTORY}, src as (select * from dir), {_address('address')} select provider_id, coalesce(canonical <> lead(canonical) over (partition by _ord % 97 order by _ord), false) as moved from ad"),
    "site_scores": (site_scores, f"with {_SITES} select provider_id, pos, domain, evidence, score, status from st"),
    "best_sites": (best_sites, f"with {_SITES} select cast(pos % 40 as varchar) as provider_id, pos, score, status from st qualify row_number() over (partition by pos % 40 order by score desc, pos) = 1"),
    "site_assertions": (site_assertions, f"""with {_SITES}, ok as (select * from st where status <> 'ambiguous_or_rejected')
select provider_id, 'address' as field, place as value, address as raw_value, 'practice_web' as source_class from ok where pos % 7 <> 0
union all select provider_id, 'phone', {_phone('phone')}, phone, 'practice_web' from ok where pos % 5 <> 0
union all select provider_id, 'practice_name', {_practice('practice_name')}, upper(practice_name), 'practice_web' from ok where pos % 2 = 0"""),
    "triage_scores": (triage_scores, f"with {_TRIAGE} select * from tr"),
    "triage_top": (triage_top, f"with {_TRIAGE} select provider_id, score from tr order by score desc, provider_id limit 25"),
    "snapshot_cases": (snapshot_cases, f"""with b as ({_SNAP("where o_orderdate < timestamp '1998-06-01'")}), n as ({_SNAP("")}),
c as (select b.npi, case when b.address <> n.address then n.address end as address, case when coalesce(b.phone, '') <> coalesce(n.phone, '') and n.phone <> '' then n.phone end as phone, case when b.status = 'A' and n.status = 'I' then 'Inactive' end as active from b join n on b.npi = n.npi)
select *, case when active is not null then 'human_review' when coalesce(address, phone) is not null then 'auto_update' else 'no_change' end as expected_action from c"""),
    "synthetic_world": (synthetic_world, f"with {_world()} select * from world"),
    "scale_backtest": (scale_backtest, f"""with {_world()}, {_SCALE}
select any_value(records) as records, count(*) as true_changes, count(*) filter (where said <> was) as detected_changes, count(*) filter (where said <> was and said = is_true) as correct_detections,
    count(*) filter (where said <> was and scenario in ('phone', 'move')) as auto_updates, count(*) filter (where said <> was and scenario in ('phone', 'move') and said = is_true) as correct_auto_updates, any_value(routing_correct) as routing_correct from ch, rt"""),
    "newest_by_key": (newest_by_key, """with e as (select cast(user_id as varchar) || ':' || event_type as key, event_id, value, props, ts from events)
select key, event_id, value, json_extract_string(props, '$.k') as k from e qualify row_number() over (partition by key order by ts desc, event_id desc) = 1 and ts > timestamp '2024-01-24 00:00:00'"""),
    "source_sets": (source_sets, f"""with {T.ASSERTIONS}, s as (select provider_id, coalesce(list(distinct source_class) filter (where value = 'F'), []) as f, coalesce(list(distinct source_class) filter (where value <> 'F'), []) as o from a group by 1)
select provider_id, array_to_string(list_sort(list_filter(f, lambda x: not list_contains(o, x))), ',') as only_f, array_to_string(list_sort(list_intersect(f, o)), ',') as "both", array_to_string(list_sort(list_distinct(list_concat(f, o))), ',') as "any" from s"""),
    "search_terms": (search_terms, f"with {T.DIRECTORY} select provider_id, concat_ws(' / ', provider_name, practice_name, phone, upper(regexp_extract(address, ',\\s*([A-Za-z]{{2}})\\s*\\d{{5}}', 1)), specialty) as terms from dir"),
    "current_values": (effective_rows, f"""with {T.DIRECTORY}, {_name('provider_name', 'nm', 'dir')}, src as (select provider_id, address, phone, active, practice_name, provider_name, canonical as person from nm), {_address('address')},
l as (select provider_id, unnest([{{'f': 'provider_name', 'r': provider_name, 'c': person}}, {{'f': 'address', 'r': address, 'c': canonical}}, {{'f': 'phone', 'r': phone, 'c': {_phone('phone')}}},
    {{'f': 'active', 'r': case when active then 'Active' else 'Inactive' end, 'c': case when active then 'active' else 'inactive' end}}, {{'f': 'practice_name', 'r': practice_name, 'c': {_practice('practice_name')}}}]) as x from ad)
select provider_id, x.f as field, x.r as raw_cur, x.c as cur from l"""),
}
