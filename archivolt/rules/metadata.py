"""Rule sets for descriptive metadata: a completeness score with flags, and a validator.

Records hold arrays of raw values per field (``dc_title`` etc.), so that repeated fields and untrimmed text can be judged.
Vocabularies, suffix and patterns are parameters; nothing here is tied to one institution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.text import first_of, non_ascii, strip, stripped_values
from archivolt.operators.profile import partial_date_year
from archivolt.rules.rule import Dimension, Rule, score, validate

#: Fixed points and limits of the score.
REQUIRED_POINTS, MOST_SUBJECTS, SHORT_DESCRIPTION = 5, 10, 80
ISO_DATE = r"\b\d{4}-\d{2}-\d{2}\b"
#: Words that count as American spelling.
AMERICAN = (
    "organiz", "recogniz", "analyz", "optimiz", "prioritiz", "finaliz", "summariz", "standardiz", "minimiz", "maximiz", "realiz", "specializ", "authoriz", "categoriz",
    "characteriz", "emphasiz", "criticiz", "apologiz", "memoriz", "visualiz", "color", "behavior", "honor", "labor", "favor", "harbor", "neighbor", "center", "centers", "defense",
    "offense", "catalog", "dialog", "analog", "program", "enrollment", "fulfill", "skillful", "traveled", "canceled", "labeled", "modeled", "modeling", "traveling", "counselor",
    "counseled", "jewelry", "gray", "maneuver", "skeptical", "pajamas",
)


@dataclass(frozen=True)
class Profile:
    """What a collection expects of its records."""

    required: Sequence[str] = ("dc_title", "dc_description", "dc_creator", "dc_date", "dc_type", "dc_format", "dc_language")
    types: Sequence[str] = ()
    content_types: Sequence[str] = ()
    languages: str = r"^[a-z]{2}(-[A-Z]{2})?$"
    formats: str = r"^[a-z]+/[a-z0-9][a-z0-9.+-]*$"
    security_tags: Sequence[str] = ("open", "closed", "public")
    subjects: Sequence[str] | None = None
    description_suffix: str = ""
    reserved: Sequence[str] = ()
    whitespace_fields: Sequence[str] = ("dc_title", "dc_creator", "dc_date", "dc_type", "dc_format", "dc_language", "dc_description", "dc_subject")
    names: Mapping[str, str] = field(default_factory=dict)
    american: Sequence[str] = AMERICAN
    #: Columns of persons and bodies by role, and a name that must be shortened in them.
    roles: Mapping[str, str] = field(default_factory=lambda: {"creator": "dc_creator"})
    full_name: str = ""
    abbreviation: str = ""
    notes: str = ""

    @property
    def spelling(self) -> str:
        return rf"(?i)\b({'|'.join(self.american)})\b"

    def label(self, column: str) -> str:
        return self.names.get(column, column)


def _values(column: str) -> Column:
    return stripped_values(F.col(column))


def _role_fault(role: str, values: Column, profile: Profile) -> Column:
    """Flag of the first faulty value of a role, null without one."""
    long = F.contains if profile.full_name else lambda v, _: F.lit(False)
    fault = lambda v: F.when(F.endswith(v, F.lit(".")), f"{role}_trailing_period").when(long(v, F.lit(profile.full_name)), f"{role}_use_{profile.abbreviation}_abbreviation")
    return F.get(F.array_compact(F.transform(values, fault)), F.lit(0))


def scorecard(df: DataFrame, profile: Profile, scalar: Sequence[str] = ("entity_title", "entity_description", "filename", "security_tag")) -> DataFrame:
    """Score of each record by seven dimensions, with flags in a fixed order.

    A role whose values hold several faults is flagged for the first faulty value only, for its full stop before its name.

    Columns of ``profile`` are arrays, those of ``scalar`` plain text. A blank field gains nothing but where being
    absent is allowed (content type, subjects, equal blanks).
    """
    title, description = first_of(_values("dc_title")), first_of(_values("dc_description"))
    e_title, e_description, file_name, tag = (strip(F.coalesce(F.col(c), F.lit(""))) for c in scalar)
    dates, subjects, formats = _values("dc_date"), _values("dc_subject"), _values("dc_format")
    type_, content, languages = first_of(_values("dc_type")), first_of(_values("icaew_content_type")), _values("dc_language")
    dated = F.forall(dates, lambda d: partial_date_year(d).isNotNull())
    # without a list of subjects every subject passes
    stray = F.array().cast("array<string>") if profile.subjects is None else F.filter(subjects, lambda s: ~s.isin(list(profile.subjects)))
    stem = F.substring_index(file_name, ".", 1)
    own_words = (F.length(description) > SHORT_DESCRIPTION) & (description != file_name) & ((file_name == "") | ~F.startswith(description, stem))
    suffix = profile.description_suffix
    has_suffix = F.endswith(description, F.lit(suffix)) if suffix else F.lit(True)
    speaks = F.forall(languages, lambda v: v.rlike(profile.languages)) & (F.size(languages) > 0)
    dims = [
        Dimension("required", [(F.size(_values(f)) > 0, REQUIRED_POINTS) for f in profile.required]),
        Dimension("consistency", [(e_title == title, 5), (e_description == description, 5)]),
        Dimension("date", [((F.size(dates) > 0) & dated, 10)]),
        Dimension("vocabulary", [(type_.isin(list(profile.types)), 5), ((content == "") | content.isin(list(profile.content_types)), 5), (speaks, 5)]),
        Dimension("subjects", [(F.size(subjects) <= MOST_SUBJECTS, 5), ((F.size(subjects) <= MOST_SUBJECTS) & (F.size(stray) == 0), 5)]),
        Dimension("description", [((description != "") & has_suffix, 5), ((description != "") & own_words, 5)]),
        Dimension("title", [((title != "") & ~F.contains(title, F.lit("&")), 2), ((title != "") & ~F.endswith(title, F.lit(".")), 2), (title.rlike(r"^[\p{Lu}\p{Nd}]"), 1)]),
    ]
    said = lambda text: F.lit(text)
    rules = [Rule(f"missing_{f}", F.size(_values(f)) == 0, said(f"missing_{profile.label(f)}"), "info") for f in profile.required]
    rules += [
        Rule("entity_title", e_title != title, said("entity_title_mismatch"), "info"),
        Rule("entity_description", e_description != description, said("entity_desc_mismatch"), "info"),
        Rule("date", ~dated, F.concat(said("invalid_date_format:"), first_of(dates)), "info"),
        Rule("type", (type_ != "") & ~type_.isin(list(profile.types)), F.concat(said("invalid_dc_type:"), type_), "info"),
        Rule("content", (content != "") & ~content.isin(list(profile.content_types)), F.concat(said("invalid_content_type:"), content), "info"),
        Rule("language", (F.size(languages) > 0) & ~speaks, F.concat(said("invalid_language:"), first_of(languages)), "info"),
        Rule("subject_count", F.size(subjects) > MOST_SUBJECTS, F.concat(said("too_many_subjects:"), F.size(subjects).cast("string")), "info"),
        Rule("subject_names", (F.size(subjects) <= MOST_SUBJECTS) & (F.size(stray) > 0), F.concat(said("invalid_subject_names:"), F.array_join(F.slice(stray, 1, 3), "|")), "info"),
        Rule("suffix", (description != "") & ~has_suffix, said("missing_ai_suffix"), "info"),
        Rule("placeholder", (description != "") & ~own_words, said("description_placeholder_or_stub"), "info"),
        Rule("ampersand", F.contains(title, F.lit("&")), said("title_contains_ampersand"), "info"),
        Rule("full_stop", F.endswith(title, F.lit(".")), said("title_trailing_fullstop"), "info"),
        Rule("lower_case", (title != "") & ~title.rlike(r"^[\p{Lu}\p{Nd}]"), said("title_lowercase_start"), "info"),
    ]
    rules += [Rule(f"reserved_{f}", F.size(_values(f)) > 0, said(f"reserved_{profile.label(f)}_populated"), "info") for f in profile.reserved]
    if suffix:
        before = strip(F.substr(description, F.lit(1), F.greatest(F.lit(0), F.length(description) - len(suffix))))
        rules.append(Rule("period", has_suffix & (before != "") & ~before.rlike(r"[.?]$"), said("description_missing_period_before_ai_suffix"), "info"))
    untidy = [F.when(F.exists(F.coalesce(F.col(f), F.array().cast("array<string>")), lambda v: v != strip(v)), F.lit(profile.label(f))) for f in profile.whitespace_fields]
    spaced = F.array_compact(F.array(*untidy))
    fmt = first_of(formats)
    rules += [
        Rule("iso_date", title.rlike(ISO_DATE), said("title_contains_iso_date"), "info"),
        Rule("american_description", description.rlike(profile.spelling), said("american_spelling_in_desc"), "info"),
        Rule("american_title", title.rlike(profile.spelling), said("american_spelling_in_title"), "info"),
        Rule("white_space", F.size(spaced) > 0, F.concat(said("whitespace_in:"), F.array_join(spaced, "|")), "info"),
        Rule("tag", (tag != "") & ~tag.isin(list(profile.security_tags)), F.concat(said("invalid_security_tag:"), tag), "info"),
        Rule(
            "format",
            (fmt != "") & ((fmt != F.lower(fmt)) | ~fmt.rlike(profile.formats)),
            F.concat(F.when(fmt != F.lower(fmt), "format_not_lowercase:").otherwise("unrecognised_format:"), fmt),
            "info",
        ),
        *[Rule(f"role_{r}", _role_fault(r, _values(c), profile).isNotNull(), _role_fault(r, _values(c), profile), "info") for r, c in profile.roles.items()],
        *([Rule("notes", F.exists(_values(profile.notes), lambda v: F.endswith(v, F.lit("."))), said("notes_trailing_period"), "info")] if profile.notes else []),
        Rule("ascii_entity_title", non_ascii(e_title), said("non_ascii_in_entity_title"), "info"),
        Rule("ascii_title", non_ascii(title), said("non_ascii_in_dc_title"), "info"),
        Rule("ascii_description", non_ascii(description), said("non_ascii_in_dc_desc"), "info"),
    ]
    return score(df, dims, rules)


#: Bands of the score, highest first.
BANDS = (("90-100", 90), ("75-89", 75), ("50-74", 50), ("25-49", 25), ("0-24", 0))


def missing_headers(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row with the required columns that a table lacks, in order; no row where it has all."""
    lacking = [c for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame([(", ".join(lacking),)] if lacking else [], "missing string")


def validator(
    df: DataFrame,
    profile: Profile,
    acronyms: Sequence[str] = (),
    proper_nouns: Sequence[str] = (),
    ignored: Sequence[str] = (),
    ascii_fields: Sequence[str] = ("dc_title", "entity_title", "dc_creator", "dc_description", "entity_description", "dc_subject", "dc_relation", "icaew_internal_reference"),
    spaced_fields: Sequence[str] = ("dc_title", "entity_title", "dc_creator", "dc_subject", "dc_relation"),
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """Errors and warnings of each record with plain text columns (F37, F38, R1, R3-R27 but R13); blank cells pass.

    Several values of a field are expected to be joined by '; '. A rule is ignored by the name of its field. ``suffixes`` are
    closing remarks of a description, before which its sentence must end.
    """
    text = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    title, date, reference, content = text("dc_title"), text("dc_date"), text("icaew_internal_reference"), text("icaew_content_type")
    type_, language, fmt = text("dc_type"), text("dc_language"), text("dc_format")
    relation, tag = text("dc_relation"), text("security_tag")
    words = F.split(title, r"\s+")
    bare = lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", "")
    shouting = list(acronyms)
    miswritten = F.exists(words, lambda w: F.upper(bare(w)).isin(shouting) & (bare(w) != F.upper(bare(w)))) if shouting else F.lit(False)
    after_colon = F.exists(
        F.slice(F.split(title, ":"), F.lit(2), F.size(F.split(title, ":"))), lambda p: strip(p).rlike(r"^\p{Lu}") & ~F.split(strip(p), r"\s+")[0].isin(shouting or [""])
    )
    say = lambda c, t: F.lit(f"{profile.label(c)}: {t}")
    rules = [
        Rule("dc_title", miswritten, say("dc_title", "acronym not in capitals")),
        Rule("dc_title", (title != "") & ~title.rlike(r"^[\p{Lu}\p{Nd}]"), say("dc_title", "must start with a capital or a digit")),
        Rule("dc_title", title.rlike("[—–]"), say("dc_title", "dash other than a hyphen")),
        Rule("dc_title", title.rlike(r"\d{4}-\d{2}-\d{2}"), say("dc_title", "ISO date")),
        Rule("dc_title", after_colon, say("dc_title", "capital after a colon")),
        Rule("dc_title", F.contains(title, F.lit("&")), say("dc_title", "ampersand")),
        Rule("dc_title", F.endswith(title, F.lit(".")), say("dc_title", "ends with a full stop")),
        Rule("dc_date", (date != "") & ~date.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), say("dc_date", "not YYYY, YYYY-MM or YYYY-MM-DD")),
        Rule("dc_date", date.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$") & partial_date_year(date).isNull(), say("dc_date", "no calendar date")),
        Rule("entity_title", text("entity_title") != title, say("entity_title", "differs from dc_title")),
        Rule("icaew_internal_reference", (reference != "") & ~reference.rlike(r"^\d{8}-[A-Za-z0-9-]+$"), say("icaew_internal_reference", "not YYYYMMDD-Name")),
        Rule("icaew_internal_reference", reference.rlike(r"^\d{4}00(?!00)\d{2}-[A-Za-z0-9-]+$"), say("icaew_internal_reference", "day without a month")),
        Rule("icaew_content_type", (content != "") & ~content.isin(list(profile.content_types)), say("icaew_content_type", "not in the vocabulary")),
        Rule("dc_type", (type_ != "") & ~type_.isin(list(profile.types)), say("dc_type", "not in the vocabulary")),
        Rule("dc_language", (language != "") & ~language.rlike(profile.languages), say("dc_language", "not a language code")),
        Rule("dc_format", fmt != F.lower(fmt), say("dc_format", "not in lower case")),
        Rule("dc_format", (fmt != "") & ~F.lower(fmt).rlike(profile.formats), say("dc_format", "unknown format")),
    ]
    parts = F.slice(F.split(reference, "-"), F.lit(2), F.greatest(F.lit(0), F.size(F.split(reference, "-")) - 1))
    titled = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
    low_acronyms = F.filter(parts, lambda w: F.upper(w).isin(shouting or [""]) & (w != F.upper(w)) & (w != ""))
    low_nouns = F.filter(parts, lambda w: titled(w).isin(list(proper_nouns) or [""]) & (w != titled(w)) & (w != ""))
    low_words = F.filter(parts, lambda w: w.rlike(r"^[^\p{Lu}0-9]"))
    named = lambda words, t: F.concat(say("icaew_internal_reference", t + ": "), F.array_join(words, ", "))
    rules += [
        Rule("icaew_internal_reference", F.size(low_acronyms) > 0, named(low_acronyms, "acronym not in capitals")),
        Rule("icaew_internal_reference", F.size(low_nouns) > 0, named(low_nouns, "name not in title case")),
        Rule("icaew_internal_reference", F.size(low_words) > 0, named(low_words, "word not in title case")),
    ]
    for c in ascii_fields:
        beyond = F.array_sort(F.array_distinct(F.regexp_extract_all(text(c), F.lit(r"[^\x00-\x7F]"), F.lit(0))))
        rules.append(Rule("non_ascii", F.size(beyond) > 0, F.concat(say(c, "characters beyond ASCII: "), F.array_join(beyond, ""))))
    for role, c in profile.roles.items():
        v = text(c)
        rules += [
            Rule(c, F.lit(role != "publisher") & F.contains(v, F.lit(";")) & F.exists(F.split(v, ";"), lambda p: F.trim(p) == ""), say(c, "empty item in the list"), "warning"),
            Rule(c, F.contains(v, F.lit(profile.full_name)) if profile.full_name else F.lit(False), say(c, f"use {profile.abbreviation}"), "warning"),
            Rule(c, F.endswith(v, F.lit(".")), say(c, "ends with a full stop"), "warning"),
        ]
    rules += [
        Rule("dc_relation", F.contains(relation, F.lit(";")) & F.exists(F.split(relation, ";"), lambda p: F.trim(p) == ""), say("dc_relation", "empty item in the list"), "warning"),
        *[Rule(c, F.contains(text(c), F.lit("  ")), say(c, "double space"), "warning") for c in spaced_fields],
    ]
    for c in ("entity_description", "dc_description"):
        v = text(c)
        at, before = F.lit(False), v
        for suffix in reversed(suffixes):
            at = F.contains(v, F.lit(suffix)) | at
            before = F.when(F.contains(v, F.lit(suffix)), strip(F.substring_index(v, suffix, 1))).otherwise(before)
        rules += [
            Rule(c, F.contains(v, F.lit("  ")), say(c, "double space"), "warning"),
            Rule(c, at & ~F.endswith(before, F.lit(".")), say(c, "no full stop before the closing remark"), "warning"),
            Rule(c, (v != "") & ~at & ~v.rlike(r"[.?]$"), say(c, "doesn't end a sentence"), "warning"),
        ]
    if profile.notes:
        rules.append(Rule(profile.notes, F.endswith(text(profile.notes), F.lit(".")), say(profile.notes, "ends with a full stop"), "warning"))
    rules.append(Rule("security_tag", (tag != "") & ~tag.isin(list(profile.security_tags)), say("security_tag", "unknown tag"), "warning"))
    return validate(df, rules, ignored)


def first_match(value: Column, cases: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first pattern that a lower-cased value contains."""
    out = None
    for needle, label in cases:
        out = (F if out is None else out).when(F.contains(F.lower(value), F.lit(needle)), label)
    return (F.lit(otherwise) if out is None else out.otherwise(otherwise)).alias("label")


def year_in(value: Column) -> Column:
    """First year of the last two centuries in a text, null without one."""
    return F.nullif(F.regexp_extract(value, r"\b((?:19|20)\d{2})\b", 1), F.lit(""))


def described(parts: Sequence[Column], separator: str = " | ") -> Column:
    """The filled parts as one description."""
    return F.array_join(F.filter(F.array(*[F.coalesce(strip(p), F.lit("")) for p in parts]), lambda p: p != ""), separator)
