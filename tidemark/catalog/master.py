"""Master ids of patients and medicines: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import cte, query
from tidemark.functions import drugs
from tidemark.functions import text as tx
from tidemark.plans.medicines import drug_codes_by_text, repair_swapped, with_companies
from tidemark.plans.people import master_patients

# --- patients ------------------------------------------------------------------------------

_ASCII = r"regexp_replace(strip_accents({c}), '[^\x00-\x7F]', '', 'g')"


def _name_sql(c: str) -> str:
    words = f"string_split_regex(trim(lower({_ASCII.format(c=c)})), '\\s+')"
    return (
        f"case when {c} is null then '' else {words}[-1] || array_to_string("
        f"list_transform({words}[:-2], lambda w: substr(w, 1, 1)), '') end"
    )


def _digits_sql(c: str, cut: str) -> str:
    return f"regexp_replace(split_part(coalesce(trim({c}), ''), '{cut}', 1), '[^0-9]', '', 'g')"


_NAME, _DOB, _PHONE = (
    _name_sql("full_name"),
    _digits_sql("date_of_birth", " "),
    _digits_sql("phone_number", "."),
)
cte(
    "user_ids",
    f"""select id as uid, full_name as user_name, date_of_birth as user_dob,
               phone_number as user_phone,
               trim(regexp_replace({_NAME} || '_' || {_DOB} || '_' || {_PHONE}, '_+', '_', 'g'), '_')
                 as master_patient_id
        from users""",
)


@query("k01_name_token", f"select id, {_NAME} as token from users")
def _(wh):
    return wh["users"].select("id", tx.name_token("full_name").alias("token"))


@query("k02_birth_digits", f"select id, {_DOB} as dob from users")
def _(wh):
    return wh["users"].select("id", tx.birth_digits("date_of_birth").alias("dob"))


@query("k03_phone_digits", f"select id, {_PHONE} as phone from users")
def _(wh):
    return wh["users"].select("id", tx.phone_digits("phone_number").alias("phone"))


@query("k04_master_id", "select uid as id, master_patient_id from user_ids")
def _(wh):
    made = tx.master_person_id("full_name", "date_of_birth", "phone_number")
    return wh["users"].select("id", made.alias("master_patient_id"))


@query(
    "k05_master_patients",
    """select 'platform' as side, p.id, p.user_id, u.uid as matched_user_id,
              coalesce(u.master_patient_id, '') as master_patient_id
       from patients p left join user_ids u on u.uid = p.user_id
       union all
       select 'clinic', p.id, p.user_id, u.uid, coalesce(u.master_patient_id, '')
       from clinic_patients p left join user_ids u on u.uid = p.user_id""",
)
def _(wh):
    users = wh["users"]
    clinic, platform = master_patients(users, wh["clinic_patients"], users, wh["patients"])
    cols = ["id", "user_id", "matched_user_id", "master_patient_id"]
    return platform.select(F.lit("platform").alias("side"), *cols).unionByName(
        clinic.select(F.lit("clinic").alias("side"), *cols)
    )


@query(
    "l03_unaccent",
    r"""select doc_id, replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D') as plain
        from documents""",
)
def _(wh):
    return wh["documents"].select("doc_id", tx.unaccent("text").alias("plain"))


# --- medicines -----------------------------------------------------------------------------


def _q(text: str) -> str:
    return text.replace("'", "''")


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _plain(x: str) -> str:
    return f"lower(replace(replace(strip_accents({x}), 'đ', 'd'), 'Đ', 'D'))"


def _norm_dose(x: str) -> str:
    return (
        f"replace(regexp_replace(replace(replace(upper(regexp_replace(coalesce({x}, ''), '\\s+', '', 'g')),"
        f" 'UI', 'IU'), ',', '.'), '[^A-Z0-9+/%.\\-]', '', 'g'), '/1ML', '/ML')"
    )


def _no_dose(x: str) -> str:
    return _squeeze(f"regexp_replace(coalesce({x}, ''), '(?i){drugs.DOSE}', ' ', 'g')")


def _no_noise(x: str) -> str:
    """One replacement after the other, longest phrase first."""
    out = _plain(f"coalesce({x}, '')")
    for phrase in sorted(drugs.NOISE_PHRASES, key=len, reverse=True):
        out = f"regexp_replace({out}, '\\b{phrase}\\b', ' ', 'g')"
    return _squeeze(out)


def _strings(values) -> str:
    return "[" + ", ".join(f"'{_q(v)}'" for v in values) + "]"


def _company_sql(x: str) -> str:
    out = _squeeze(f"regexp_replace({_plain(f'coalesce({x}, chr(32))')}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g')")
    for phrase in drugs.COMPANY_PHRASES:
        out = f"regexp_replace({out}, '\\b{phrase}\\b', ' ', 'g')"
    return _squeeze(out)


_DOSES = (
    f"list_filter(list_transform(regexp_extract_all({{c}}, '(?i){drugs.DOSE}'), "
    f"lambda d: {_norm_dose('d')}), lambda d: d <> '')"
)
_ONLY = (
    f"active_element is not null and {_norm_dose('trim(active_element)')} <> '' and "
    f"len(list_filter(string_split({_norm_dose('trim(active_element)')}, '+'), "
    f"lambda p: p <> '' and not regexp_full_match(p, '(?i){drugs.DOSE}'))) = 0"
)


@query(
    "k06_doses",
    f"""select id, name, {_norm_dose(f"regexp_extract(coalesce(active_element, ''), '(?i){drugs.DOSE}', 0)")} as first,
               array_to_string({_DOSES.format(c="coalesce(concentration, '')")}, '|') as every,
               {_no_dose('active_element')} as rest, coalesce({_ONLY}, false) as only_dose
        from medicines""",
)
def _(wh):
    active, strength = F.col("active_element"), F.col("concentration")
    return wh["medicines"].select(
        "id",
        "name",
        drugs.first_dose(active).alias("first"),
        F.array_join(drugs.all_doses(strength), "|").alias("every"),
        drugs.remove_doses(active).alias("rest"),
        drugs.is_only_dose(active).alias("only_dose"),
    )


@query(
    "k07_noise_words",
    f"""select id, name, {_no_noise('active_element')} as quiet,
               array_to_string(list_filter(string_split({_squeeze("coalesce(active_element, '')")}, ' '),
                 lambda w: w <> '' and not list_contains({_strings(drugs.FORM_WORDS + drugs.SALT_WORDS)}, w)), ' ')
                 as kept
        from medicines""",
)
def _(wh):
    active = F.coalesce(F.col("active_element"), F.lit(""))
    return wh["medicines"].select(
        "id", "name", drugs.remove_noise(active).alias("quiet"), drugs.kept_words(active).alias("kept")
    )


cte(
    "med_rows",
    f"""select *, row_number() over () as rid,
               case when swap then concentration else active_element end as act,
               case when swap then active_element else concentration end as str
        from (select *, coalesce({_ONLY}, false) and concentration is not null
                and not list_contains({_strings(drugs.BLANK_TEXTS)}, lower(trim(concentration))) as swap
              from medicines)""",
)
cte(
    "med_parts",
    r"""select rid, 0 as g, regexp_replace(coalesce(act, ''), '[\(\[\{][^\)\]\}]+[\)\]\}]', ' ', 'g') as part
        from med_rows
        union all
        select rid, generate_subscripts(b, 1), unnest(b)
        from (select rid, regexp_extract_all(coalesce(act, ''), '[\(\[\{]([^\)\]\}]+)[\)\]\}]', 1) as b
              from med_rows)""",
)
cte(
    "med_segments",
    f"""select rid, g, i, trim(regexp_replace(seg, '\\s+', ' ', 'g')) as seg
        from (select rid, g, unnest(p) as seg, generate_subscripts(p, 1) as i
              from (select rid, g, string_split_regex({_squeeze('part')}, '(?i)\\s*(?:\\+|;|,|/|\\bva\\b|&)\\s*') as p
                    from med_parts
                    where g = 0 or not (regexp_matches({_squeeze(_plain('part'))}, '{drugs.FORM_PREFIX}')
                                        or regexp_matches({_plain('part')}, '{drugs.ALIAS}'))))
        where trim(seg) <> ''""",
)
_FAMILY = " ".join(f"when regexp_matches(t, '{p}') then '{n}'" for p, n in drugs.FAMILIES)


def _same_as(x: str) -> str:
    for pattern, other in drugs.SAME_AS:
        x = f"regexp_replace({x}, '{pattern}', '{other}', 'g')"
    return x


_KEPT = f"""array_to_string(list_filter(string_split(t, ' '), lambda w: w <> ''
  and not list_contains({_strings(drugs.FORM_WORDS + drugs.SALT_WORDS)}, w)), ' ')"""
cte(
    "med_names",
    f"""select rid, g, i, seg, s, case when regexp_matches(s, '{drugs.TOCOPHEROL}') then 'tocopheryl acetate'
               {_FAMILY} else {_squeeze(_same_as(_KEPT))} end as name
        from (select *, {_squeeze("regexp_replace(s, '[^\\p{L}\\p{M}\\p{N}_\\s\\-]', ' ', 'g')")} as t
              from (select *, {_no_noise(_no_dose('a'))} as s
                    from (select *, {_no_noise(_no_dose('seg'))} as a from med_segments)))""",
)
_CODE_CASE = " ".join(f"when name = '{n}' then '{c}'" for n, c in drugs.ACTIVE_CODES.items())
_FORMS = _strings(drugs.EXTRACT_FORMS)
_PHRASE = f"""upper(array_to_string(case
   when w[1] = 'cao' and list_contains({_FORMS}, w[2])
     then w[1:2] || (case when len(w) >= 4 then w[3:4] else w[-1:] end)
   when w[1] = 'cao' then w[1:1] || (case when len(w) >= 3 then w[2:3] else w[-1:] end)
   when w[1:3] = ['ban', 'ha', 'che'] then w[1:3] else w[1:2] end, ''))"""
cte(
    "med_coded",
    f"""select rid, g, i, seg, name, case when name = '' then '' {_CODE_CASE}
               when seg <> replace(replace(strip_accents(seg), 'đ', 'd'), 'Đ', 'D') then {_PHRASE}
               else upper(substr(regexp_replace(string_split(name, ' ')[1], '[^a-z0-9]', '', 'g'), 1, 6))
               end as code, {_PHRASE} as phrase
        from (select *, list_filter(string_split({_squeeze("regexp_replace(one, '[^a-z0-9\\s]', ' ', 'g')")}, ' '),
                  lambda x: x <> '' and not list_contains({_strings(drugs.PHRASE_IGNORE)}, x)) as w
              from (select *, {_no_noise(_no_dose('seg'))} as one from med_names))""",
)
cte(
    "med_pairs",
    f"""select p.rid, p.k, p.name, p.code,
               case when p.own <> '' then p.own
                    when list_contains({_strings(drugs.BLANK_TEXTS)}, lower(trim(coalesce(m.str, '')))) then ''
                    else coalesce(({_DOSES.format(c='m.str')})[p.k], '') end as dose
        from (select rid, name, code, own, row_number() over (partition by rid order by g, i) as k
              from (select *, {_norm_dose(f"regexp_extract(seg, '(?i){drugs.DOSE}', 0)")} as own
                    from med_coded where name <> ''
                    qualify row_number() over (partition by rid, name order by g, i) = 1)) p
        join med_rows m on m.rid = p.rid where p.k <= 2""",
)
cte(
    "med_codes",
    """select rid, string_agg(code, '+' order by k) as codes,
              coalesce(string_agg(dose, '+' order by k) filter (where dose <> ''), '') as doses
       from (select rid, code, min(k) as k,
                    coalesce(arg_min(dose, k) filter (where dose <> ''), '') as dose
             from med_pairs where code <> '' group by rid, code) group by rid""",
)


def _trim_address(x: str) -> str:
    words = "|".join(drugs.ADDRESS_WORDS)
    x = f"regexp_replace({x}, '\\b(?:{words})\\b.*$', ' ')"
    x = f"regexp_replace({x}, '\\b\\d{{4,}}\\b', ' ', 'g')"
    return _squeeze(
        f"regexp_replace({x}, '\\b[a-z]*\\d+[a-z]+\\b|\\b[a-z]+\\d+[a-z]*\\b', ' ', 'g')"
    )


def _drop_countries(x: str) -> str:
    for country in drugs.COUNTRIES:
        x = f"regexp_replace({x}, '(?:\\s+{country})$', '')"
    return x


cte(
    "company_words",
    f"""select manufacturer, coalesce(
               (select w[:n] from (select unnest(range(len(w) // 2, 1, -1)) as n)
                where w[:n] = w[n + 1:2 * n] order by n desc limit 1), w) as w
        from (select manufacturer, string_split({_trim_address(_drop_countries('c'))}, ' ') as w
              from (select distinct manufacturer, {_company_sql('manufacturer')} as c from medicines))""",
)
cte(
    "companies",
    """select manufacturer,
              array_to_string(list_transform(w, lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' ')
                as manufacturer_normalized,
              upper(case when len(w) = 1 then substr(w[1], 1, 4)
                    else array_to_string(list_transform(w, lambda x:
                      case when regexp_full_match(x, '[0-9]{1,3}') then x else substr(x, 1, 1) end), '')
                    end) as manufacturer_code
       from company_words""",
)
cte(
    "drug_table",
    """select m.rid, m.id::varchar as source_medicine_id, m.name, m.active_element, m.concentration,
              m.manufacturer,
              coalesce(case when d.doses <> '' then d.codes || '_' || d.doses else d.codes end, '')
                as drug_code,
              c.manufacturer_code, c.manufacturer_normalized
       from med_rows m left join med_codes d on d.rid = m.rid
       left join companies c on c.manufacturer is not distinct from m.manufacturer""",
)
_MASTER = "trim(drug_code || '__' || manufacturer_code, '_') as master_drug_code"


@query(
    "k08_segments",
    """select m.id, m.name, coalesce(s.parts, '') as parts from med_rows m left join
       (select rid, string_agg(seg, '|' order by g, i) as parts from med_segments group by rid) s
       on s.rid = m.rid""",
)
def _(wh):
    rows = repair_swapped(wh["medicines"])
    parts = drugs.segments(drugs.drop_equivalent(F.col("__active")))
    return rows.select("id", "name", F.array_join(parts, "|").alias("parts"))


def _segments(wh):
    parts = drugs.segments(drugs.drop_equivalent(F.col("__active")))
    return repair_swapped(wh["medicines"]).select("id", F.explode(parts).alias("seg"))


@query(
    "k09_canonical_names",
    "select m.id, n.seg, n.name from med_names n join med_rows m on m.rid = n.rid",
)
def _(wh):
    return _segments(wh).withColumn("name", drugs.canonical(drugs.canonical_input(F.col("seg"))))


@query(
    "k10_phrase_code",
    "select m.id, n.seg, n.phrase from med_coded n join med_rows m on m.rid = n.rid",
)
def _(wh):
    return _segments(wh).withColumn("phrase", drugs.phrase_code(F.col("seg")))


@query(
    "k11_active_code",
    "select m.id, n.seg, n.code from med_coded n join med_rows m on m.rid = n.rid",
)
def _(wh):
    named = _segments(wh).withColumn("name", drugs.canonical(drugs.canonical_input(F.col("seg"))))
    return named.select("id", "seg", drugs.active_code(F.col("name"), F.col("seg")).alias("code"))


@query(
    "k12_active_pairs",
    """select m.id, m.name, coalesce(p.pairs, '') as pairs from med_rows m left join
       (select rid, string_agg(code || ':' || name || ':' || dose, '|' order by k) as pairs
        from med_pairs group by rid) p on p.rid = m.rid""",
)
def _(wh):
    pairs = drugs.active_pairs(F.col("__active"), F.col("__strength"))
    text = F.transform(pairs, lambda p: F.concat_ws(":", p["code"], p["name"], p["dose"]))
    return repair_swapped(wh["medicines"]).select(
        "id", "name", F.array_join(text, "|").alias("pairs")
    )


@query(
    "k13_company_code",
    "select m.id, m.name, manufacturer_normalized, manufacturer_code from drug_table d join med_rows m on m.rid = d.rid",
)
def _(wh):
    return with_companies(wh["medicines"]).select("id", "name", "manufacturer_normalized", "manufacturer_code")


@query(
    "k14_master_drug_code",
    f"select * exclude (rid, manufacturer_normalized), {_MASTER} from drug_table",
)
def _(wh):
    return drug_codes_by_text(wh["medicines"])


@query(
    "k15_master_drug_code_extra",
    f"""select d.* exclude (rid), {_MASTER}, coalesce(p.pairs, '') as pairs from drug_table d left join
        (select rid, string_agg(name || '::' || dose, ' | ' order by k) as pairs
         from (select rid, code, min(k) as k, arg_min(name, k + 10 * (dose = '')::int) as name,
                      arg_min(dose, k + 10 * (dose = '')::int) as dose
               from med_pairs where code <> '' group by rid, code) group by rid) p on p.rid = d.rid""",
)
def _(wh):
    return drug_codes_by_text(wh["medicines"], extra=True)
