"""Filters, relational joins, aggregates, quality checks and schema changes on business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravia.operators import enrich, evolve, filters, key_runs, quality
from terravia.plans.fixtures import TABLES, table, view, with_views
from terravia.plans.registry import query
from terravia.session import scratch_path

PRIVILEGES = ("click", "error", "purchase", "signup", "view")


# -- filters -----------------------------------------------------------------------------------


@query("subset_filter", with_views("segment") + " select seg_id, lib_rte, x1, y1, x2, y2 from segment where gestionnaire = 'OWN'")
def subset_filter(spark, sf):
    return view(spark, sf, "segment").where("gestionnaire = 'OWN'").drop("gestionnaire")


@query("attribute_tag", with_views("feat_attr") + " select gid, cei_field, cei_field as _cei from feat_attr")
def attribute_tag(spark, sf):
    return filters.attribute_tag(view(spark, sf, "feat_attr"), "cei_field", "_cei")


@query(
    "domain_check",
    with_views("feat_attr", "lookup") + """
    select distinct cei_field from feat_attr where upper(cei_field) not in (select cei from lookup)""",
)
def domain_check(spark, sf):
    return filters.domain_check(view(spark, sf, "feat_attr"), "cei_field", view(spark, sf, "lookup"), "cei")


@query(
    "upper_match",
    with_views("feat_attr", "lookup") + """
    select gid, upper(cei_field) in (select cei from lookup) as known from feat_attr""",
)
def upper_match(spark, sf):
    known = view(spark, sf, "lookup").select(F.col("cei").alias("_key")).distinct()
    feat = view(spark, sf, "feat_attr")
    joined = feat.join(known, F.upper("cei_field") == F.col("_key"), "left")
    return joined.select("gid", F.col("_key").isNotNull().alias("known"))


@query("name_regex_filter", "select p_partkey, p_name from part where not regexp_matches(p_name, '^re')")
def name_regex_filter(spark, sf):
    """Names without a prefix."""
    return table(spark, sf, "part").where(~F.col("p_name").rlike("^re")).select("p_partkey", "p_name")


@query("name_regex_filter_anywhere", "select p_partkey, p_name from part where not regexp_matches(p_name, 're')")
def name_regex_filter_anywhere(spark, sf):
    """Names without a text anywhere."""
    return table(spark, sf, "part").where(~F.col("p_name").rlike("re")).select("p_partkey", "p_name")


@query(
    "value_list_filter",
    """select o_orderkey, o_orderstatus, o_orderpriority from orders
       where o_orderstatus in ('F', 'O') and o_orderpriority not in ('5-LOW', '3-MEDIUM', '2-HIGH')
         and (o_orderstatus = 'F' or o_orderpriority = '1-URGENT')""",
)
def value_list_filter(spark, sf):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
        .where(status.isin("F", "O") & ~priority.isin("5-LOW", "3-MEDIUM", "2-HIGH"))
        .where((status == "F") | (priority == "1-URGENT"))
    )


def _sets(spark, sf):
    return filters.capability_sets(view(spark, sf, "grants"), "object_id", "privilege", PRIVILEGES)


@query(
    "capability_set",
    with_views("grants") + """
    select object_id, string_agg(privilege, ',' order by privilege) as privileges from grants group by object_id""",
)
def capability_set(spark, sf):
    return _sets(spark, sf).select("object_id", F.array_join("privileges", ",").alias("privileges"))


@query(
    "capability_containment",
    with_views("grants", "object") + """
    select object_id, type from grants join object using (object_id) where type = 'r'
    group by object_id, type having count_if(privilege in ('error', 'signup')) = 2""",
)
def capability_containment(spark, sf):
    """Objects of one type that hold all requested privileges."""
    typed = _sets(spark, sf).join(view(spark, sf, "object"), "object_id")
    return filters.with_capabilities(typed, ["error", "signup"], type="r").select("object_id", "type")


@query(
    "capability_listing",
    with_views("grants", "object") + """
    select schema, object_id, type, geom_column from grants join object using (object_id)
    where type = 'v' and schema = 'roads' group by all having count_if(privilege = 'view') = 1
    order by schema, object_id""",
)
def capability_listing(spark, sf):
    """Objects of one schema and type with their geometry column, by schema and object."""
    typed = _sets(spark, sf).join(view(spark, sf, "object"), "object_id")
    found = filters.with_capabilities(typed, ["view"], type="v", schema="roads")
    return found.select("schema", "object_id", "type", "geom_column").orderBy("schema", "object_id")


@query(
    "capability_schemas",
    with_views("grants", "object") + """
    select schema from grants join object using (object_id)
    where not regexp_matches(schema, 'pg_') group by schema
    having count(distinct privilege) filter (privilege in ('click', 'purchase')) = 2 order by schema""",
)
def capability_schemas(spark, sf):
    """Schemas, but for the system's, in which all requested privileges are held."""
    named = view(spark, sf, "grants").join(view(spark, sf, "object").select("object_id", "schema"), "object_id")
    sets = filters.capability_sets(named, "schema", "privilege", PRIVILEGES)
    found = filters.with_capabilities(sets.where(~F.col("schema").rlike("pg_")), ["click", "purchase"])
    return found.select("schema").orderBy("schema")


@query(
    "point_privilege",
    with_views("grants") + " select object_id, "
    + ", ".join(f"bool_or(privilege = '{p}') as can_{p}" for p in PRIVILEGES[:4])
    + " from grants group by object_id",
)
def point_privilege(spark, sf):
    """One flag per privilege."""
    held = F.col("privileges")
    return _sets(spark, sf).select("object_id", *[filters.holds(held, p).alias(f"can_{p}") for p in PRIVILEGES[:4]])


# -- joins -------------------------------------------------------------------------------------


@query(
    "update_from",
    """select c_custkey, case when n_nationkey is not null then n_name else c_mktsegment end as c_mktsegment
       from customer left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey""",
)
def update_from(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    source = table(spark, sf, "nation").where("n_regionkey <> 0")
    updated = enrich.update_from(customer, source, "c_nationkey", "c_mktsegment", "n_name", "n_nationkey")
    return updated.select("c_custkey", "c_mktsegment")


@query(
    "lookup_district",
    with_views("feat_attr", "lookup") + """
    select gid, cei_field as _cei, district as _district from feat_attr left join lookup on cei_field = cei""",
)
def lookup_district(spark, sf):
    tagged = view(spark, sf, "feat_attr").withColumnRenamed("cei_field", "_cei")
    return enrich.lookup_value(tagged, view(spark, sf, "lookup"), "_cei", "cei", "district", "_district")


@query(
    "star_join",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, o_orderstatus, returned
       from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey
       join supplier on s_suppkey = l_suppkey
       left join (select l_orderkey as k1, l_linenumber as k2, count(*) as returned from lineitem
                  where l_returnflag = 'R' group by 1, 2) on k1 = l_orderkey and k2 = l_linenumber
       where s_acctbal > 0""",
)
def star_join(spark, sf):
    """Three inner joins and a left join on a two-column key."""
    lineitem = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    returned = lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("returned")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return (
        lineitem.drop("l_returnflag").join(supplier, "l_suppkey").join(part, "l_partkey").join(orders, "l_orderkey")
        .join(returned, ["l_orderkey", "l_linenumber"], "left")
    )


@query(
    "two_role_join",
    """select c.n_name as customer_nation, s.n_name as supplier_nation, r_name as region, count(*) as n
       from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
       join supplier on s_suppkey = l_suppkey
       left join nation c on c.n_nationkey = c_nationkey left join nation s on s.n_nationkey = s_nationkey
       join region on r_regionkey = c.n_regionkey
       group by 1, 2, 3""",
)
def two_role_join(spark, sf):
    """The nation table in two roles; both left joins, then an inner join on the first role.

    Rows are counted per (customer nation key, supplier nation key) before names are attached.
    """
    lineitem = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation")
    buyer = nation.toDF("c_nationkey", "customer_nation", "r_regionkey")
    seller = nation.select("n_nationkey", "n_name").toDF("s_nationkey", "supplier_nation")
    counted = (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.join(buyer, "c_nationkey", "left").join(seller, "s_nationkey", "left")
        .join(table(spark, sf, "region"), "r_regionkey")
        .select("customer_nation", "supplier_nation", F.col("r_name").alias("region"), "n")
    )


@query(
    "left_join_or_condition",
    """select c_custkey, n_name from customer left join nation on n_nationkey = c_nationkey
       and (n_name = 'NATION_3' or n_nationkey in (select s_nationkey from supplier where s_acctbal < 0))""",
)
def left_join_or_condition(spark, sf):
    """The OR becomes a mark on the right side, so the join itself stays an equi-join."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    listed = table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("_key")).distinct()
    marked = nation.join(listed, F.col("n_nationkey") == F.col("_key"), "left")
    chosen = marked.where((F.col("n_name") == "NATION_3") | F.col("_key").isNotNull())
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return customer.join(chosen, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query(
    "semi_join_in",
    """select o_orderkey, o_orderstatus from orders where o_orderkey in (
         select l_orderkey from lineitem, part where p_partkey = l_partkey and p_type = 'PROMO' and l_returnflag <> 'R')""",
)
def semi_join_in(spark, sf):
    promo = table(spark, sf, "part").where("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select("l_orderkey", "l_partkey")
    wanted = lines.join(promo, "l_partkey", "left_semi").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(wanted, "o_orderkey", "left_semi")


@query(
    "merge_coalesce",
    """select d.doc_id, source, coalesce(l.quality, -1) as quality, coalesce(l.toxic, -1) as toxic
       from documents d left join labels l on l.doc_id = d.doc_id""",
)
def merge_coalesce(spark, sf):
    base = table(spark, sf, "documents").select(
        "doc_id", "source", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic")
    )
    return enrich.overlay(base, table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])


# -- aggregates and order ----------------------------------------------------------------------


@query("row_count", " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in TABLES))
def row_count(spark, sf):
    counts = [
        table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in TABLES
    ]
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return total


@query("distinct_values", "select distinct c_mktsegment from customer")
def distinct_values(spark, sf):
    return filters.distinct_values(table(spark, sf, "customer"), "c_mktsegment")


@query("existence_count", "select count(*) > 0 as found from part where p_type = 'PROMO' and p_size > 10")
def existence_count(spark, sf):
    return table(spark, sf, "part").where("p_type = 'PROMO' and p_size > 10").agg(
        (F.count(F.lit(1)) > 0).alias("found")
    )


@query(
    "ordered_listing",
    "select c_custkey, c_mktsegment, c_nationkey from customer order by c_mktsegment, c_nationkey, c_custkey",
)
def ordered_listing(spark, sf):
    keys = ("c_mktsegment", "c_nationkey", "c_custkey")
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey").orderBy(
        *[F.col(k).asc_nulls_last() for k in keys]
    )


# -- quality -----------------------------------------------------------------------------------


@query(
    "check_primary_key",
    """select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2
       having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
)
def check_primary_key(spark, sf):
    return quality.check_primary_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_primary_key_choice",
    """select count(*) as n_rows, case when count(distinct o_orderkey) = count(*) then 'o_orderkey' else 'gid' end as key
       from orders
       union all
       select count(*), case when count(distinct l_orderkey) = count(*) then 'l_orderkey' else 'gid' end from lineitem""",
)
def check_primary_key_choice(spark, sf):
    """The key a load ends up with: the candidate when it holds, else the fallback."""
    rows = []
    for name, candidate in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        df = table(spark, sf, name)
        key = quality.choose_key(df, candidate).key[0]
        rows.append(df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("key", F.lit(key)))
    return rows[0].unionByName(rows[1])


@query(
    "check_primary_key_incremental",
    """select l_orderkey, l_suppkey, count(*) as n from lineitem group by 1, 2
       having count(*) > 1 or l_orderkey is null or l_suppkey is null""",
)
def check_primary_key_incremental(spark, sf):
    """A key that repeats, checked in three batches of which each meets only the stored keys of those before it."""
    lineitem, path = table(spark, sf, "lineitem"), scratch_path(spark, "keys")
    for batch in ("l_linenumber <= 2 or l_linenumber is null", "l_linenumber in (3, 4)", "l_linenumber > 4"):
        key_runs.add_keys(lineitem.where(batch), ["l_orderkey", "l_suppkey"], path)
    return key_runs.broken_keys(spark, path)


@query(
    "check_foreign_key_incremental",
    """select o_orderkey, o_custkey from orders where o_custkey not in
       (select c_custkey from customer where c_acctbal >= 0 or c_mktsegment = 'BUILDING')""",
)
def check_foreign_key_incremental(spark, sf):
    """Orders whose customer is in neither of two batches of customers."""
    customer, path = table(spark, sf, "customer"), scratch_path(spark, "keys")
    key_runs.add_keys(customer.where("c_acctbal >= 0"), "c_custkey", path)
    key_runs.add_keys(customer.where("c_acctbal < 0 and c_mktsegment = 'BUILDING'"), "c_custkey", path)
    return key_runs.without_parent(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", path)


@query(
    "check_unique_incremental",
    "select c_nationkey, c_mktsegment, count(*) as n from customer where c_nationkey is not null and c_mktsegment is not null "
    "group by 1, 2 having count(*) > 1",
)
def check_unique_incremental(spark, sf):
    """The same in two batches of customers."""
    customer, path = table(spark, sf, "customer"), scratch_path(spark, "keys")
    for batch in ("c_acctbal >= 0", "c_acctbal < 0 or c_acctbal is null"):
        key_runs.add_keys(customer.where(batch), ["c_nationkey", "c_mktsegment"], path)
    return key_runs.repeated_keys(spark, path)


@query("check_unique", "select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2 having count(*) > 1")
def check_unique(spark, sf):
    return quality.check_unique(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


NULLED = "case when c_custkey % 9 = 0 then null else c_mktsegment end"


@query("check_not_null", f"select c_custkey, {NULLED} as c_mktsegment from customer where {NULLED} is null")
def check_not_null(spark, sf):
    holed = table(spark, sf, "customer").selectExpr("c_custkey", f"{NULLED} as c_mktsegment")
    return quality.check_not_null(holed, ["c_custkey", "c_mktsegment"])


@query(
    "check_foreign_key",
    "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal >= 0)",
)
def check_foreign_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.check_foreign_key(orders, "o_custkey", table(spark, sf, "customer").where("c_acctbal >= 0"), "c_custkey")


@query(
    "check_predicate",
    "select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem where not (l_quantity * l_discount < 4.5)",
)
def check_predicate(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return quality.check_predicate(lines, F.col("l_quantity") * F.col("l_discount") < 4.5)


@query("length_guard", "select p_partkey, p_name from part where length(p_name) > 10")
def length_guard(spark, sf):
    return quality.length_guard(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 10)


# -- schema changes ----------------------------------------------------------------------------


def _customer(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


@query("add_column", "select c_custkey, c_name, c_acctbal, 'none' as _cei from customer")
def add_column(spark, sf):
    return evolve.add_column(_customer(spark, sf), "_cei", "string", "none")


@query("drop_column", "select c_custkey, c_acctbal from customer")
def drop_column(spark, sf):
    return evolve.drop_column(_customer(spark, sf), "c_name")


@query("rename_column", "select c_custkey, c_name as label, c_acctbal from customer")
def rename_column(spark, sf):
    return evolve.rename_column(_customer(spark, sf), "c_name", "label")


@query("set_type", "select p_partkey, cast(p_size as varchar) as p_size from part")
def set_type(spark, sf):
    return evolve.set_type(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", "string")


@query(
    "set_default",
    """select c_custkey, c_name, c_acctbal from customer
       union all select c_custkey + 1000000000, 'unnamed', c_acctbal from customer where c_acctbal < 0""",
)
def set_default(spark, sf):
    """A default fills rows appended later and leaves existing ones alone."""
    base = evolve.set_default(_customer(spark, sf), "c_name", "unnamed")
    new = _customer(spark, sf).where("c_acctbal < 0").select(
        (F.col("c_custkey") + 1000000000).alias("c_custkey"), "c_acctbal"
    )
    return evolve.append_rows(base, new)


@query(
    "append_rows",
    "select n_nationkey, n_name, n_regionkey from nation union all select s_suppkey + 100, s_name, null from supplier",
)
def append_rows(spark, sf):
    new = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 100).alias("n_nationkey"), F.col("s_name").alias("n_name")
    )
    grown = evolve.append_rows(table(spark, sf, "nation"), new)
    return grown.withColumn("n_nationkey", F.col("n_nationkey").cast("bigint"))


@query("add_geometry_column", "select c_custkey, true as geom_is_null, 'POINT' as kind, 2154 as srid, 2 as dim from customer")
def add_geometry_column(spark, sf):
    typed = evolve.add_geometry_column(_customer(spark, sf), "geom", "POINT", 2154)
    declared = typed.schema["geom"].metadata
    return typed.select(
        "c_custkey",
        F.col("geom").isNull().alias("geom_is_null"),
        F.lit(declared["kind"]).alias("kind"),
        F.lit(declared["srid"]).alias("srid"),
        F.lit(declared["dim"]).alias("dim"),
    )
