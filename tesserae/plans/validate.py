"""Record validation: a compiled schema becomes columns, over a VARIANT or over a table's own columns; every violation is
reported, in one narrow pass inside code generation.

Absent, null and wrong type stay apart in records; in tables null is absent. Predicates never yield SQL null: presence is
tested first, and a test of the wrong kind of value is vacuously true where the schema language says so.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
VIOLATION = "struct<kind:string,field:string,rule:int>"


def _and(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _or(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def get(record: Column, name: str) -> Column:
    """A member as VARIANT: SQL null if absent, variant null if JSON null."""
    return F.try_variant_get(record, f"$['{name}']", "variant")


def _kind(x: Column) -> Column:
    return F.coalesce(F.schema_of_variant(x), F.lit("VOID"))


def _once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """rows with columns that are worked out once a row. A filter on a plain projection would be pushed below it and carry
    the columns' expressions along, each as often as it is named; none passes the generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))) if columns else rows


class Member:
    """A value in a VARIANT: its kind, and what it is as text and as number."""

    def __init__(self, x: Column):
        self.x, self.kind = x, _kind(x)
        self.text, self.number = F.try_variant_get(x, "$", "string"), F.try_variant_get(x, "$", "double")
        self.present, self.null = x.isNotNull(), F.is_variant_null(x)

    def get(self, name: str) -> Member:
        return Member(get(self.x, name))

    def each(self, test) -> Column:
        return F.forall(F.try_variant_get(self.x, "$", "array<variant>"), lambda e: test(Member(e)))


class Parts:
    """A record whose members stand in columns of their own, worked out once: _x, _kind, _text, _number by property."""

    def __init__(self, record: Column, names: list[str]):
        self.inner, self.names = Member(record), {k: i for i, k in enumerate(names)}
        self.kind, self.text, self.number, self.present, self.null = F.lit("OBJECT"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(True), F.lit(False)

    def added(self, rows: DataFrame) -> DataFrame:
        """rows with those columns."""
        member = {i: self.inner.get(k) for k, i in self.names.items()}
        rows = _once(rows, {f"_x{i}": m.x for i, m in member.items()})
        return _once(rows, {f"_{c}{i}": getattr(Member(F.col(f"_x{i}")), c) for i in member for c in ("kind", "text", "number")})

    def get(self, name: str) -> Member:
        i = self.names[name]
        out = Member(F.col(f"_x{i}"))
        out.kind, out.text, out.number = F.col(f"_kind{i}"), F.col(f"_text{i}"), F.col(f"_number{i}")
        return out


def named(schema: dict) -> list[str]:
    """The properties that a schema's object keywords speak of."""
    own = {*schema.get("required", []), *(schema.get("properties") or {})}
    for part in [*schema.get("allOf", []), *[schema[k] for k in ("if", "then", "not") if isinstance(schema.get(k), dict)], *schema.get("anyOf", [])]:
        own.update(named(part))
    return sorted(own)


class Cell:
    """A value in a typed column; null is absent."""

    KINDS = {"tinyint": "BIGINT", "smallint": "BIGINT", "int": "BIGINT", "bigint": "BIGINT", "float": "DOUBLE", "double": "DOUBLE", "boolean": "BOOLEAN"}

    def __init__(self, x: Column, type: str):
        known = "DECIMAL" if type.startswith("decimal") else "ARRAY" if type.startswith("array") else "OBJECT" if type.startswith(("struct", "map")) else self.KINDS.get(type, "STRING")
        self.x, self.type, self.kind, self.present, self.null = x, type, F.lit(known), x.isNotNull(), x.isNull()
        self.text = x.cast("string") if known in ("STRING", "BOOLEAN") else F.lit(None).cast("string")
        self.number = x.cast("double") if known in ("BIGINT", "DOUBLE", "DECIMAL") else F.lit(None).cast("double")

    def get(self, name: str) -> Cell:
        return Cell(F.lit(None).cast("string"), "string")

    def each(self, test) -> Column:
        return F.forall(self.x, lambda e: test(Cell(e, self.type[6:-1]))) if self.type.startswith("array") else F.lit(True)


class Row:
    """A table's row as a record."""

    def __init__(self, rows: DataFrame):
        self.types, self.kind, self.present, self.null = dict(rows.dtypes), F.lit("OBJECT"), F.lit(True), F.lit(False)
        self.text, self.number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def get(self, name: str) -> Cell:
        return Cell(F.col(f"`{name}`"), self.types[name]) if name in self.types else Cell(F.lit(None).cast("string"), "string")


Value = Member | Parts | Cell | Row


def _value(x: Column | Value) -> Value:
    return Member(x) if isinstance(x, Column) else x


def of_type(x: Column | Value, name: str) -> Column:
    x = _value(x)
    if name == "string":
        return x.kind == "STRING"
    if name == "number":
        return x.kind.rlike(NUMERIC)
    if name == "integer":
        return (x.kind == "BIGINT") | (x.kind.rlike(NUMERIC) & F.coalesce(x.number % 1 == 0, F.lit(False)))
    if name == "array":
        return x.kind.startswith("ARRAY")
    if name == "object":
        return x.kind.startswith("OBJECT")
    if name == "boolean":
        return x.kind == "BOOLEAN"
    return x.kind == "VOID"


def valid(schema: dict, x: Column | Value) -> Column:
    """Whether a present value meets a schema."""
    x = _value(x)
    kind, text, number = x.kind, x.text, x.number
    out = []
    if "type" in schema:
        names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        out.append(_or([of_type(x, n) for n in names]))
    for labels in ([schema["enum"]] if "enum" in schema else []) + ([[schema["const"]]] if "const" in schema else []):
        words, numbers = [v for v in labels if isinstance(v, str)], [float(v) for v in labels if isinstance(v, (int, float)) and not isinstance(v, bool)]
        tests = ([(kind == "STRING") & F.coalesce(text.isin(words), F.lit(False))] if words else []) + ([kind.rlike(NUMERIC) & F.coalesce(number.isin(numbers), F.lit(False))] if numbers else [])
        flags = [str(v).lower() for v in labels if isinstance(v, bool)]
        tests += [(kind == "BOOLEAN") & F.coalesce(text.isin(flags), F.lit(False))] if flags else []
        tests += [kind == "VOID"] if None in labels else []
        out.append(_or(tests))
    if "anyOf" in schema:
        out.append(_or([valid(s, x) for s in schema["anyOf"]]))
    if "not" in schema:
        out.append(~valid(schema["not"], x))
    if "maximum" in schema:
        out.append(~kind.rlike(NUMERIC) | F.coalesce(number <= float(schema["maximum"]), F.lit(True)))
    if "minimum" in schema:
        out.append(~kind.rlike(NUMERIC) | F.coalesce(number >= float(schema["minimum"]), F.lit(True)))
    if "pattern" in schema:
        out.append((kind != "STRING") | F.coalesce(text.rlike(schema["pattern"]), F.lit(True)))
    if schema.get("items"):
        out.append(~kind.startswith("ARRAY") | F.coalesce(x.each(lambda e: valid(schema["items"], e)), F.lit(True)))
    if "properties" in schema or "required" in schema:
        out.append(~kind.startswith("OBJECT") | holds(schema, x))
    return _and(out)


def holds(schema: dict, record: Column | Value) -> Column:
    """Whether a record meets the object keywords of a schema; a property that is absent is met."""
    record = _value(record)
    tests = [record.get(k).present for k in schema.get("required", [])]
    tests += [~record.get(k).present | valid(s, record.get(k)) for k, s in (schema.get("properties") or {}).items() if s]
    tests += [valid({"not": schema["not"]}, record)] if "not" in schema else []
    return _and(tests)


def _kinds(schema: dict) -> list[tuple[str, dict]]:
    """A property schema as separately reported keywords."""
    return [(k, {k: schema[k]}) for k in ("type", "enum", "const", "anyOf", "not", "maximum", "minimum", "pattern", "items") if k in schema]


def violations(schema: dict, record: Column | Value, null_as_absent: bool = False) -> Column:
    """array<struct<kind, field, rule>>: all violations of a record; rule is null outside if/then rules.
    null_as_absent: for tables in which null and absent are one."""
    record = _value(record)
    found: list[Column] = []

    def present(k: str) -> Column:
        x = record.get(k)
        return x.present & ~x.null if null_as_absent else x.present

    def report(bad: Column, kind: str, field: str, rule: int | None) -> None:
        one = F.struct(F.lit(kind).alias("kind"), F.lit(field).alias("field"), F.lit(rule).cast("int").alias("rule"))
        found.append(F.when(bad, F.array(one)).otherwise(F.array().cast(f"array<{VIOLATION}>")))

    def check(part: dict, when: Column | None, rule: int | None) -> None:
        guard = F.lit(True) if when is None else when
        for k in part.get("required", []):
            report(guard & ~present(k), "required", k, rule)
        for k, s in (part.get("properties") or {}).items():
            for kind, keyword in _kinds(s):
                report(guard & present(k) & ~valid(keyword, record.get(k)), kind, k, rule)
        if "not" in part:
            report(guard & ~holds({"not": part["not"]}, record), "not", "", rule)

    check(schema, None, None)
    conditionals = [*schema.get("allOf", []), *([{"if": schema["if"], "then": schema.get("then", {})}] if "if" in schema else [])]
    for i, rule in enumerate(conditionals):
        check(rule.get("then", {}), holds(rule["if"], record), i)
    # joined arrays stay inside code generation; filtering one array of nulls would not
    return F.concat(*found) if found else F.array().cast(f"array<{VIOLATION}>")


def validate_table(rows: DataFrame, schema: dict) -> DataFrame:
    """rows with `violations` and `valid`: the columns themselves are the record, null is absent; no text is made or parsed."""
    return rows.withColumn("violations", violations(schema, Row(rows))).withColumn("valid", F.size("violations") == 0)


def validate(records: DataFrame, schema: dict, json: str = "json", null_as_absent: bool = False) -> DataFrame:
    """records with `violations` and `valid`; text that is no JSON object has one violation of kind `json`."""
    record = Parts(F.col("_v"), named(schema))
    parsed = record.added(_once(records, {"_v": F.try_parse_json(json)}))
    bad = F.col("_v").isNull() | ~F.coalesce(F.schema_of_variant("_v"), F.lit("")).startswith("OBJECT")
    broken = F.array(F.struct(F.lit("json").alias("kind"), F.lit("").alias("field"), F.lit(None).cast("int").alias("rule")))
    out = parsed.select(*records.columns, F.when(bad, broken).otherwise(violations(schema, record, null_as_absent)).alias("violations"))
    return out.withColumn("valid", F.size("violations") == 0)


def long_form(validated: DataFrame, *keys: str) -> DataFrame:
    """One row per violation."""
    # an inner explode would filter by the array's size below the projection that makes it
    return validated.select(*keys, F.explode_outer("violations").alias("v")).where("v IS NOT NULL").select(*keys, "v.*")


def summary(validated: DataFrame) -> DataFrame:
    """(kind, field, rule, records): how many records each rule rejects."""
    return long_form(validated).groupBy("kind", "field", "rule").agg(F.count("*").alias("records"))


def verdicts(validated: DataFrame, registry: DataFrame, on: str = "file") -> DataFrame:
    """Expected against actual: (…, expected, actual, agrees)."""
    actual = F.when(F.col("valid"), "valid").otherwise("invalid")
    return registry.join(validated.select(on, actual.alias("actual")), on).withColumn("agrees", F.col("expected") == F.col("actual"))
