"""Event documents as VARIANT: normalisation, validation against rules, the disposition cascade and the projections.

Rules are a document of their own (types, lengths, patterns, required fields, nested rules), compiled to one column
expression that lists every error with its path. All of it runs beside the data; only texts beyond ASCII reach Python,
for canonical composition.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import canonical_json, lower_escapes, namespaced, nfc
from siltstone.operators.ingest import HISTORICAL, SENSITIVE_KEY, compatibility, has_float, record_id, redaction_hits, said, suspect
from siltstone.schemas import ENVELOPE_RULES, VALIDATION_OUTCOMES
from siltstone.session import cut, spread

ERRORS = "array<struct<path:string,message:string>>"
OBJECT, LIST = "map<string,variant>", "array<variant>"


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` looks at it."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), F.lit(0))


def child(value: Column, name: str) -> Column:
    """A field of an object: null if it is missing or ``value`` is no object."""
    return F.try_variant_get(value, f"$['{name}']", "variant")


def text_at(value: Column, *path: str) -> Column:
    """The string at a path; null for what is missing, empty or of another type."""
    found = F.try_variant_get(value, "$" + "".join(f"['{name}']" for name in path), "variant")
    return let(found, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.nullif(F.try_variant_get(v, "$", "string"), F.lit(""))))


def kind(value: Column) -> Column:
    """The JSON type of a VARIANT: object, array, string, integer, number, boolean or null; SQL null if there is none."""
    return let(F.struct(value.alias("v"), F.schema_of_variant(value).alias("s")), lambda x: (
        F.when(x["v"].isNull(), F.lit(None).cast("string"))
        .when(x["s"] == "VOID", "null")
        .when(F.startswith(x["s"], F.lit("OBJECT")), "object")
        .when(F.startswith(x["s"], F.lit("ARRAY")), "array")
        .when(x["s"] == "STRING", "string")
        .when(x["s"] == "BOOLEAN", "boolean")
        .when((x["s"] == "BIGINT") | (F.try_variant_get(x["v"], "$", "double") == F.floor(F.try_variant_get(x["v"], "$", "double"))), "integer")
        .otherwise("number")
    ))


def errors_of(value: Column, rules: dict, path: Column | str = "") -> Column:
    """All violations of ``rules`` by a VARIANT, as (path, message); an absent value has none.

    Understands type, const, enum, minLength, maxLength, pattern, minimum, required, properties, additionalProperties
    (false), items and uniqueItems.
    """
    return let(F.struct(value.alias("v"), kind(value).alias("k")), lambda x: checked(x["v"], x["k"], rules, path))


def checked(value: Column, is_a: Column, rules: dict, path: Column | str) -> Column:
    at = F.lit(path) if isinstance(path, str) else path
    under = lambda name: F.lit(f"{path}/{name}".lstrip("/")) if isinstance(path, str) else F.concat(path, F.lit("/"), name if isinstance(name, Column) else F.lit(name))
    error = lambda where, message: F.struct(where.alias("path"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))
    text = F.try_variant_get(value, "$", "string")
    none = F.from_json(F.lit("[]"), ERRORS)
    checks = []
    if "type" in rules:
        kinds = [rules["type"]] if isinstance(rules["type"], str) else rules["type"]
        checks.append((~is_a.isin(*kinds, *(["integer"] if "number" in kinds else [])), F.concat(F.lit(f"is not of type {' or '.join(kinds)}, but "), is_a)))
    for name, allowed in (("const", [rules.get("const")]), ("enum", rules.get("enum"))):
        if name in rules:
            words, nothing = [x for x in allowed if x is not None], None in allowed
            checks.append((~((is_a == "string") & text.isin(*words)) & ~((is_a == "null") & F.lit(nothing)), f"is none of {', '.join(words)}"))
    string = is_a == "string"
    if "minLength" in rules:
        checks.append((string & (F.length(text) < rules["minLength"]), f"is shorter than {rules['minLength']}"))
    if "maxLength" in rules:
        checks.append((string & (F.length(text) > rules["maxLength"]), f"is longer than {rules['maxLength']}"))
    if "pattern" in rules:
        checks.append((string & ~text.rlike(rules["pattern"]), f"does not match {rules['pattern']}"))
    if "minimum" in rules:
        checks.append((is_a.isin("integer", "number") & (F.try_variant_get(value, "$", "double") < rules["minimum"]), f"is less than {rules['minimum']}"))
    items = F.try_variant_get(value, "$", LIST)
    if rules.get("uniqueItems"):
        checks.append(((is_a == "array") & (F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < F.size(items)), "has repeated items"))
    found = [F.array_compact(F.array(*(F.when(bad, error(at, message)) for bad, message in checks)))] if checks else []
    if "items" in rules:
        inner = F.flatten(F.transform(items, lambda x, k: errors_of(x, rules["items"], F.concat(at, F.lit("/") if not isinstance(path, str) or path else F.lit(""), k.cast("string")))))
        found.append(F.when(is_a == "array", inner).otherwise(none))
    names = rules.get("properties", {})
    missing = [F.when(child(value, n).isNull(), error(under(n), "is missing")) for n in rules.get("required", ())]
    if rules.get("additionalProperties") is False:
        extra = F.array_sort(F.array_except(F.map_keys(F.try_variant_get(value, "$", OBJECT)), F.array(*map(F.lit, names))))
        missing.append(F.when(F.size(extra) > 0, error(at, F.concat(F.lit("has unknown fields "), F.array_join(extra, ", ")))))
    if missing:
        found.append(F.when(is_a == "object", F.array_compact(F.array(*missing))).otherwise(none))
    found += [errors_of(child(value, n), inner, under(n) if not isinstance(path, str) else f"{path}/{n}".lstrip("/")) for n, inner in names.items()]
    return F.when(value.isNull(), none).otherwise(F.concat(*found) if found else none)


STRING = r'"[^"\\]*+"'  #: A text without escapes, as it stands in JSON.
SCALAR = rf"(?:{STRING}|-?\d++|true|false|null)"


def shape(rules: dict, path: str = "") -> str | None:
    """A pattern that canonical JSON without any violation of ``rules`` has; None if the rules have no such pattern.

    What matches is valid; what doesn't may be: texts with escapes and objects in free objects are left to
    ``errors_of``. Keys are in order in canonical JSON, so each has its place.
    """
    if not set(rules) <= {"type", "const", "enum", "minLength", "maxLength", "pattern", "required", "properties", "additionalProperties", "items", "uniqueItems"}:
        return None
    if "const" in rules or "enum" in rules:
        allowed = [rules["const"]] if "const" in rules else rules["enum"]
        plain = all(x is None or (isinstance(x, str) and re.fullmatch(r"[A-Za-z0-9_./-]+", x)) for x in allowed)
        return "(?:" + "|".join("null" if x is None else f'"{re.escape(x)}"' for x in allowed) + ")" if plain and set(rules) <= {"const", "enum"} and len(rules) == 1 else None
    kinds = rules.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    ways = []
    for name in kinds:
        if name == "null":
            ways.append("null")
        elif name == "string":
            ahead = ""
            if "pattern" in rules:
                inner = re.fullmatch(r"\^(.*)\$", rules["pattern"])
                # Only patterns that can't reach beyond the text's own end: no dot, no complement, no quote.
                if not inner or '"' in inner[1] or re.search(r"[.\\\[]", re.sub(r"\\[.d]|\[[^\]^\\\[][^\]\\\[]*\]", "", inner[1])):
                    return None
                ahead = f'(?=(?:{inner[1]})")'
            ways.append(rf'"{ahead}[^"\\]{{{rules.get("minLength", 0)},{rules.get("maxLength", "")}}}+"')
        elif name == "array":
            item = shape(rules["items"], path) if "items" in rules else SCALAR
            if item is None:
                return None
            if rules.get("uniqueItems"):  # of texts up to 16, as each is compared with those behind it; of others at most one
                many = 15 if item.startswith('(?:"') and rules["items"].get("type") == "string" else 0
                mark = "u" + "".join(c for c in path if c.isalnum())
                item = rf"(?<{mark}>{item})(?!(?:,{STRING})*?,\k<{mark}>)" if many else item
                ways.append(rf"\[(?:{item}(?:,{item.replace(f'<{mark}>', f'<{mark}x>')}){{0,{many}}}+)?+\]")
            else:
                ways.append(rf"\[(?:{item}(?:,{item})*+)?+\]")
        elif name == "object":
            fields, needed = rules.get("properties"), set(rules.get("required", ()))
            if fields is None:
                if needed or rules.get("additionalProperties") is False:
                    return None
                ways.append(rf"\{{(?:{STRING}:{SCALAR}(?:,{STRING}:{SCALAR})*+)?+\}}")
                continue
            parts = {k: shape(v, path + k) for k, v in sorted(fields.items())}
            if None in parts.values() or not needed <= set(fields) or not all(re.fullmatch(r"\w+", k) for k in fields):
                return None
            each = "".join(f'(?:(?:(?<=\\{{)|,)"{k}":{v})' + ("" if k in needed else "?+") for k, v in parts.items())
            ways.append(rf"\{{{each}\}}")
        else:
            return None
    return "(?:" + "|".join(ways) + ")" if ways else None


def all_errors(text: Column, rules: dict) -> Column:
    """``errors_of`` a canonical JSON text; one that has the rules' ``shape`` has none without being taken apart."""
    found = errors_of(F.try_parse_json(text), rules)
    whole = shape(rules)
    return found if whole is None else F.when(text.rlike(rf"\A{whole}\z"), F.from_json(F.lit("[]"), ERRORS)).otherwise(found)


def sorted_set(value: Column) -> Column:
    """A VARIANT array of strings without repeats in order; anything else as it is."""
    items = F.try_variant_get(value, "$", LIST)
    strings = F.coalesce(F.forall(items, lambda x: F.schema_of_variant(x) == "STRING"), F.lit(False))
    return F.when(strings, F.to_variant_object(F.array_sort(F.array_distinct(F.try_variant_get(value, "$", "array<string>"))))).otherwise(value)


def by_field(value: Column) -> Column:
    """A VARIANT array of objects in order of their field and reason; anything else as it is."""
    name = lambda x: F.concat_ws("\0", F.coalesce(F.try_variant_get(x, "$.field", "string"), F.lit("")), F.coalesce(F.try_variant_get(x, "$.reason", "string"), F.lit("")))
    items = F.try_variant_get(value, "$", LIST)
    order = F.array_sort(items, lambda a, b: F.when(name(a) < name(b), -1).when(name(a) > name(b), 1).otherwise(0))
    return F.when(items.isNotNull(), F.to_variant_object(order)).otherwise(value)


def with_normal_form(rows: DataFrame, doc: str = "document", name: str = "normal") -> DataFrame:
    """``rows`` with the normal form of an event document: canonical JSON with every key and text in canonical
    composition, set-like arrays sorted and distinct, and an empty list where limitations are missing.

    Null for what is no JSON object, repeats a key (also by composition), or has a number with a fraction.
    """
    wide = F.col("__text").rlike(r"[^\x00-\x7F]")
    rows = rows.withColumn("__v", F.try_parse_json(doc)).withColumns({"__text": F.to_json("__v"), "__list": child(F.col("__v"), "limitations")})
    rows = rows.withColumns({"__text": lower_escapes(F.col("__text")), "__json": F.to_json("__list"), "__items": F.try_variant_get("__list", "$", "array<string>")}).drop("__v", "__list")
    rows = rows.withColumn("__text", F.when(wide, nfc(F.col("__text"))).otherwise(F.col("__text")))
    rows = rows.withColumn("__text", F.when(wide, canonical_json(F.col("__text"))).otherwise(F.col("__text")))
    fields = F.try_variant_get(F.try_parse_json(F.when(~has_float(F.col("__text")), F.col("__text"))), "$", OBJECT)
    lineage = lambda x: let(F.try_variant_get(x, "$", OBJECT), lambda m: F.coalesce(F.to_variant_object(F.transform_values(m, lambda k, v: F.when(k == "parent_event_ids", sorted_set(v)).otherwise(v))), x))
    ordered = F.transform_values(fields, lambda k, v: F.when(k == "limitations", sorted_set(v)).when(k == "unknowns", by_field(v)).when(k == "lineage", lineage(v)).otherwise(v))
    empty = F.create_map(F.lit("limitations"), F.parse_json(F.lit("[]")))
    whole = let(ordered, lambda m: F.to_json(F.to_variant_object(F.when(F.array_contains(F.map_keys(m), "limitations"), m).otherwise(F.map_concat(m, empty)))))
    # Mostly only the limitations change. Where they are plain texts and stand once in a text without escapes, they are
    # exchanged in place; the fragment's quotes can be in no other text, and a second one would be a field further in.
    t, old = F.col("__text"), F.concat(F.lit('"limitations":'), F.col("__json"))
    new = F.concat(F.lit('"limitations":["'), F.array_join(F.sort_array(F.array_distinct("__items")), '","'), F.lit('"]'))
    once = F.length(t) - F.length(F.replace(t, old, F.lit(""))) == F.length(old)
    apart = ~t.rlike(r"[^\x00-\x7F]|\\|\d[.eE]") & ~F.contains(t, F.lit('"unknowns":')) & ~F.contains(t, F.lit('"lineage":'))
    quick = F.coalesce(apart & F.col("__json").rlike(rf"\A\[{STRING}(?:,{STRING})*+\]\z") & once, F.lit(False))
    rows = rows.withColumn("__quick", F.when(quick, F.replace(t, old, new)))
    rows = rows.withColumn(name, F.when(F.col("__quick").isNotNull(), F.col("__quick")).otherwise(whole))
    return rows.withColumn(name, lower_escapes(F.col(name))).drop("__text", "__json", "__items", "__quick")


def json_strings(doc: Column) -> Column:
    """Keys (with a colon behind them) and text values of a canonical JSON text, in quotes, unescaped but for what the
    two marks stand for. Escapes leave first, so that a string is what stands between two quotes, however long."""
    text = F.replace(F.replace(doc, F.lit("\\\\"), F.lit(SLASH)), F.lit('\\"'), F.lit(QUOTE))
    text = F.regexp_replace(text, r"\\([nrtbf]|u[0-9a-f]{4})", " ")
    return F.regexp_extract_all(text, F.lit('"[^"]*":?'), F.lit(0))


SLASH, QUOTE = "\x01", "\x02"


def document_hits(doc: Column) -> Column:
    """Names of the redaction rules that keys or texts anywhere in a canonical JSON text break."""
    inner = lambda p: F.replace(F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit(SLASH), F.lit("\\")), F.lit(QUOTE), F.lit('"'))
    key = lambda p: F.endswith(p, F.lit(":"))
    hits = lambda p: F.when(key(p), F.array_compact(F.array(F.when(p.rlike(SENSITIVE_KEY), F.lit("sensitive_key"))))).otherwise(let(inner(p), redaction_hits))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(json_strings(doc), lambda p: hits(p)))))


#: The envelope's fields that redaction looks at.
INSPECTED = ("snapshot_or_run_id", "limitations", "unknowns", "lineage", "payload")


def opened(deliveries: DataFrame) -> DataFrame:
    """``deliveries`` (delivery, document) with ``event`` (VARIANT of the normal form, null if malformed), its hash, its
    fields as columns, and payload and payload hash."""
    rows = cut(with_normal_form(spread(deliveries)))  # written once; all that follows reads it
    rows = rows.withColumn("event", F.try_parse_json("normal"))
    fields = ("event_id", "producer_id", "producer_contract", "sdk_contract", "event_class", "event_time", "snapshot_or_run_id", "redaction_status")
    rows = rows.withColumns({f"__{n}": child(F.col("event"), n) for n in (*fields, "payload")})  # columns of their own, not parts of one expression
    rows = rows.withColumns({n: F.when(F.schema_of_variant(f"__{n}") == "STRING", F.nullif(F.try_variant_get(f"__{n}", "$", "string"), F.lit(""))) for n in fields})
    rows = rows.withColumn("payload", F.when(F.startswith(F.schema_of_variant("__payload"), F.lit("OBJECT")), F.to_json("__payload"))).drop(*(f"__{n}" for n in (*fields, "payload")))
    return rows.withColumns({"payload": lower_escapes(F.col("payload")), "event_hash": F.sha2(F.coalesce("normal", "document"), 256)}).withColumn("payload_hash", F.sha2("payload", 256))


def validation_errors(deliveries: DataFrame, rules: dict = ENVELOPE_RULES) -> DataFrame:
    """(delivery, path, message): every error of every delivery, in order of path; a malformed one has the path ''."""
    rows = cut(with_normal_form(spread(deliveries.select("delivery", "document"))))
    malformed = F.array(F.struct(F.lit("").alias("path"), F.lit("is malformed").alias("message")))
    found = F.when(F.col("normal").isNull(), malformed).otherwise(all_errors(F.col("normal"), rules))
    return rows.select("delivery", F.explode(found).alias("e")).select("delivery", "e.*")


def judged(deliveries: DataFrame, known: DataFrame, rules: dict = ENVELOPE_RULES) -> DataFrame:
    """``opened`` deliveries with record_id and reason: why a delivery can't be accepted whatever else was delivered.

    The first that holds decides: malformed, against the rules, against the registry, marked for quarantine by its
    producer, or with sensitive keys or texts in what redaction inspects.
    """
    rows = opened(deliveries)
    seen = F.to_json(F.to_variant_object(F.array(*(child(F.col("event"), n) for n in INSPECTED))))
    rows = rows.withColumn("__small", F.lower("normal"))
    hits = F.when(suspect(F.col("__small")), F.size(document_hits(canonical_json(seen)))).otherwise(0)
    rows = rows.withColumns({"wrong": F.size(all_errors(F.col("normal"), rules)), "hits": hits})
    rows = compatibility(cut(rows.drop("event", "document", "__small")), known)  # the expensive columns once, not again in what uses them
    rows = rows.withColumn("record_id", F.when(F.col("normal").isNotNull() & (F.col("wrong") == 0), record_id(rows)))
    reason = (
        F.when(F.col("normal").isNull(), "malformed_event")
        .when(F.col("wrong") > 0, "invalid_schema")
        .when(F.col("incompatible").isNotNull(), F.col("incompatible"))
        .when(F.col("redaction_status") == "quarantine_required", "redaction_required")
        .when(F.col("hits") > 0, "sensitive_content")
    )
    return rows.withColumn("reason", reason).drop("wrong", "hits", "incompatible")


def dispositions(deliveries: DataFrame, known: DataFrame, stored: DataFrame | None = None, rules: dict = ENVELOPE_RULES) -> DataFrame:
    """Each delivery (delivery, document) with record_id, reason and disposition.

    ``stored`` (record_id, payload_hash): records that the corpus has already. Of acceptable deliveries of a record
    that isn't stored the first is accepted; the others are duplicates, and so are those of a stored record, unless its
    payload is another one: a collision. Of repeated rows of one delivery one is the first. A null delivery comes first.
    """
    rows = judged(deliveries, known, rules)
    if stored is None:
        rows = rows.withColumn("stored_hash", F.lit(None).cast("string"))
    else:
        one = stored.groupBy("record_id").agg(F.min("payload_hash").alias("stored_hash"))
        rows = rows.join(one, "record_id", "left")
    collides = F.col("reason").isNull() & (F.col("stored_hash") != F.col("payload_hash"))
    rows = rows.withColumn("reason", F.when(collides, "fingerprint_collision").otherwise(F.col("reason")))
    # Two firsts: the smallest delivery of a record, then one row of it; a hot record is combined before the shuffle.
    firsts = rows.where("reason is null and stored_hash is null").groupBy("record_id").agg(F.min(F.struct("delivery")).alias("f")).select("record_id", F.col("f.delivery").alias("first"), F.lit(True).alias("new"))
    rows = rows.join(firsts, "record_id", "left").withColumn("candidate", F.col("reason").isNull() & F.coalesce("new", F.lit(False)) & F.col("delivery").eqNullSafe(F.col("first")))
    again = F.row_number().over(Window.partitionBy("record_id", "delivery", "candidate").orderBy("event_hash"))
    status = F.when(F.col("reason").isNotNull(), "quarantined").when(F.col("candidate") & (F.col("again") == 1), "accepted").otherwise("duplicate")
    return rows.withColumn("again", again).withColumn("disposition", status).drop("first", "new", "candidate", "again", "stored_hash", "normal")


# --- projections ---------------------------------------------------------------------------------------------------

#: The contracts that have a projection of their own.
SDK, RESOLVER, HISTORY = "finding-bundle/v1", "resolver-feedback/v1", "historical-resolution/v1"


def observations(events: DataFrame) -> DataFrame:
    """The learning observations of accepted events (record_id, producer_id, event_class, producer_contract, payload as
    canonical JSON), dispatched by contract: one per finding of a bundle, else one per event.

    A contract without a projection gives a record-local observation, so that no accepted event is missing. Scope falls
    back to the record. What can't be known is null, and ``limitations`` says so, in order. One pass over the events:
    each branch is an array that one explode opens, so nothing is read four times.
    """
    events = spread(events).withColumn("__payload", F.try_parse_json("payload"))  # parsed once, and not for each finding
    p = F.col("__payload")
    record = F.col("record_id").cast("string")
    text = lambda *path: F.col("__" + "_".join(path))
    paths = [("repository_pseudonym",), ("repository_identity",), ("validation", "result"), ("validation", "duration_bucket"), ("validation", "outcome"), ("failure", "fingerprint"), ("failure", "semantic_failure_identity"), ("failure", "identity_authority"), ("resolution", "remediation_class"), ("intervention", "remediation_class")]
    whose = {"resolution": RESOLVER, "intervention": HISTORY, "repository_identity": HISTORY, "failure": (RESOLVER, HISTORY), "validation": (RESOLVER, HISTORY)}
    reads = lambda path: F.col("producer_contract").isin(*[whose[path[0]]] if isinstance(whose[path[0]], str) else whose[path[0]]) if path[0] in whose else F.lit(True)
    at = lambda path: F.try_variant_get(p, "$" + "".join(f"['{name}']" for name in path), "variant")
    events = events.withColumns({"__v_" + "_".join(path): F.when(reads(path), at(path)) for path in paths})
    one = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.nullif(F.try_variant_get(v, "$", "string"), F.lit("")))
    events = events.withColumns({"__" + "_".join(path): one(F.col("__v_" + "_".join(path))) for path in paths})
    null = F.lit(None).cast("string")
    local = F.concat(F.lit("record:"), record)
    alone = namespaced("record", record)
    notes = lambda *pairs: F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), t if isinstance(t, Column) else F.lit(t)) for c, t in pairs)))

    def row(scope, key, rule=null, repository=null, component=null, remediation=null, outcome=null, disposition=null, limitations=None):
        fields = {"occurrence_scope": scope, "recurrence_fingerprint": key, "canonical_rule_id": rule, "repository_identity": repository, "component": component, "remediation_class": remediation, "validation_outcome": outcome, "false_positive_disposition": disposition}
        return F.struct(*(c.alias(n) for n, c in fields.items()), F.lit(None).cast("long").alias("effort_minutes"), limitations.alias("limitations"))

    pseudonym = text("repository_pseudonym")
    scope, no_scope = F.coalesce(pseudonym, local), (pseudonym.isNull(), "scope is record-local: no repository")

    is_object = lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    findings = F.filter(F.try_variant_get(p, "$.bundle.findings", LIST), is_object)
    def finding(f: Column) -> Column:
        rule = text_at(f, "canonical_rule_id")
        key = F.when(rule.isNotNull(), namespaced("rule", rule)).otherwise(namespaced("producer-fingerprint", F.coalesce(text_at(f, "fingerprint"), text_at(f, "finding_id"), record)))
        place = F.filter(F.try_variant_get(f, "$.locations", LIST), is_object)
        return row(scope, key, rule, pseudonym, text_at(F.get(place, F.lit(0)), "normalized_path"), limitations=notes(no_scope, (rule.isNull(), "recurrence is of the instance: no rule")))

    given = text("validation", "result")
    resolver_key = text("failure", "fingerprint")
    resolver = row(
        scope, F.coalesce(namespaced("failure", resolver_key), alone), repository=pseudonym, remediation=text("resolution", "remediation_class"),
        outcome=F.when(given.isin(*VALIDATION_OUTCOMES), given).when(given.isNotNull(), "unknown"),
        limitations=notes(no_scope, (resolver_key.isNull(), "recurrence is record-local: no failure"), (~given.isin(*VALIDATION_OUTCOMES), F.concat(F.lit("result unknown: "), given)), (text("validation", "duration_bucket").isNotNull(), "effort is a bucket")))

    repository, identity = text("repository_identity"), text("failure", "semantic_failure_identity")
    authority, ended = text("failure", "identity_authority"), text("validation", "outcome")
    table = F.create_map(*(F.lit(x) for kv in HISTORICAL.items() for x in kv))
    outcome = F.when(ended.isNotNull(), F.coalesce(F.try_element_at(table, ended), F.lit("unknown")))
    flake = F.coalesce(F.try_variant_get(p, "$.historical_evidence.suspected_flake", "boolean"), F.lit(False))
    history = row(
        F.coalesce(repository, local), F.coalesce(namespaced("failure", identity), alone), F.when(authority == "canonical", identity), F.coalesce(repository, local),
        remediation=text("intervention", "remediation_class"), outcome=outcome, disposition=F.when(flake, "inconclusive").when(outcome == "passed", "confirmed_true_positive"),
        limitations=notes((repository.isNull(), "scope is record-local: no repository"), (identity.isNull(), "recurrence is record-local: no failure"), (authority != "canonical", F.concat(F.lit("rule unknown: authority "), authority)),
                          (~ended.isin(*HISTORICAL), F.concat(F.lit("outcome unknown: "), ended)), (flake, "suspected flake: no repair credit"), (F.lit(True), "effort is unknown: reconstructed")))

    generic = row(scope, alone, limitations=notes(no_scope, (F.lit(True), F.concat(F.lit("no projection for "), F.col("producer_contract")))))
    contract = F.col("producer_contract")
    branch = F.when(contract == SDK, F.transform(findings, finding)).when(contract == RESOLVER, F.array(resolver)).when(contract == HISTORY, F.array(history)).otherwise(F.array(generic))
    return events.select("record_id", "producer_id", "event_class", "producer_contract", F.explode(branch).alias("o")).select("record_id", "producer_id", "event_class", "producer_contract", "o.*")
