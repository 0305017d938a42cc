"""Fraud-graph features over the customer relations and the shared devices."""

from pyspark.sql import functions as F

from loanloom.operators import graph
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import DEFAULTS, DEVICE, EDGE, LOAN, RELATION, r6, uniform
from loanloom.plans.profile_queries import rounded
from loanloom.session import cut_lineage, hold
from loanloom.sources import marts
from loanloom.sources.tables import table

FEATURES = EDGE + ", " + LOAN + ", " + DEFAULTS + """,
nb AS (SELECT src, count(*) AS degree, sum(d.isDefault)::BIGINT AS bad, max(weight) AS mw, sum(weight * d.isDefault) / (sum(weight) + 1e-6) AS wr
  FROM edge JOIN defaults d ON d.customer_id = dst GROUP BY 1),
tri AS (SELECT a.src AS id, count(*) AS t FROM edge a JOIN edge b ON a.dst = b.src JOIN edge c ON b.dst = c.src AND c.dst = a.src
  WHERE a.dst < b.dst GROUP BY 1),
feat AS (SELECT customer_id, coalesce(degree, 0) AS degree, coalesce(bad, 0) AS bad, coalesce(mw, 0) AS mw, coalesce(wr, 0) AS wr, coalesce(t, 0) AS t
  FROM defaults LEFT JOIN nb ON src = customer_id LEFT JOIN tri ON id = customer_id)"""


def _edges(spark, folder):
    return hold(graph.relation_edges(marts.relations(spark, folder)))


def _customers(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))


@query("relation_edges", f"WITH {EDGE} SELECT src, dst, weight FROM edge")
def relation_edges(spark, folder):
    return graph.relation_edges(marts.relations(spark, folder))


@query("relation_edges_as_of", f"""
WITH {RELATION} SELECT count(*) AS n_relations, count(DISTINCT customer_id_1) AS n_customers FROM relation WHERE relation_start_date <= DATE '1999-01-01'""")
def relation_edges_as_of(spark, folder):
    past = graph.dated_before(marts.relations(spark, folder), "relation_start_date", "1999-01-01")
    return past.agg(F.count("*").alias("n_relations"), F.count_distinct("customer_id_1").alias("n_customers"))


@query("neighbour_features", f"""
WITH {FEATURES} SELECT customer_id, degree, bad AS bad_neighbor_count, {r6('bad / greatest(degree, 1)')} AS bad_neighbor_rate, mw AS max_edge_weight,
  {r6('wr')} AS weighted_bad_rate, degree - bad AS good_neighbors, {r6('CASE WHEN degree > 1 THEN 2 * t / (degree * (degree - 1)) ELSE 0 END')} AS clustering,
  {r6('degree / ((SELECT count(*) FROM customer) - 1)')} AS degree_centrality FROM feat""")
def neighbour_features(spark, folder):
    return rounded(graph.neighbour_features(_edges(spark, folder), marts.customer_defaults(spark, folder), "customer_id", "isDefault"))


@query("star_and_ring", f"""
WITH {FEATURES}, lk AS MATERIALIZED (SELECT a.src AS u, b.dst AS w, a.dst AS v FROM edge a JOIN edge b ON a.dst = b.src WHERE a.src < b.dst),
opposite AS (SELECT u, w, count(*) AS c FROM lk GROUP BY 1, 2 HAVING count(*) > 1),
four AS (SELECT v AS id, sum(c - 1) AS q FROM lk JOIN opposite USING (u, w) GROUP BY 1)
SELECT customer_id, degree >= 5 AND CASE WHEN degree > 1 THEN 2 * t / (degree * (degree - 1)) ELSE 0 END <= 0.1 AS is_star, t > 0 AS in_ring,
  t AS n_rings_of_3, coalesce(q, 0)::BIGINT AS n_rings_of_4 FROM feat LEFT JOIN four ON id = customer_id""")
def star_and_ring(spark, folder):
    e = _edges(spark, folder)
    ranked = cut_lineage(graph.ranked_edges(e))
    tri = cut_lineage(graph.triangles(e, ranked))
    f = graph.neighbour_features(e, marts.customer_defaults(spark, folder), "customer_id", "isDefault", tri)
    return graph.star_and_ring(f, tri, graph.squares(e, ranked), "customer_id")


TWO_HOP = """p AS (SELECT DISTINCT a.src AS v, b.dst AS w FROM edge a JOIN edge b ON a.dst = b.src WHERE a.src <> b.dst),
far AS (SELECT v, count(*) AS n FROM p GROUP BY 1)"""


@query("two_hop_counts", f"""
WITH {EDGE}, {TWO_HOP}
SELECT c_custkey AS customer_id, coalesce(n, 0) AS n_two_hop FROM customer LEFT JOIN far ON v = c_custkey""")
def two_hop_counts(spark, folder):
    return graph.two_hop_counts(_edges(spark, folder), _customers(spark, folder), "customer_id").drop("exact")


@query("two_hop_sketches", f"""
WITH {EDGE}, {TWO_HOP}
SELECT c_custkey AS customer_id, coalesce(n, 0) AS n_two_hop, true AS within_bound FROM customer LEFT JOIN far ON v = c_custkey""")
def two_hop_sketches(spark, folder):
    """The sketched counts of all vertices beside the exact ones: five standard errors are the bound shown."""
    e, who = _edges(spark, folder), _customers(spark, folder)
    exact = graph.two_hop_counts(e, who, "customer_id")
    guessed = graph.two_hop_counts(e, who, "customer_id", most_paths=0).select(F.col("customer_id").alias("_id"), F.col("n_two_hop").alias("guess"))
    bound = 1 + 5 * 1.04 / 2 ** (graph.SKETCH_BITS / 2) * F.col("n_two_hop")
    return exact.join(guessed, F.col("customer_id") == F.col("_id")).select(
        "customer_id", "n_two_hop", (F.abs(F.col("guess") - F.col("n_two_hop")) <= bound).alias("within_bound"))


@query("hops_from_negative_balance", f"""
WITH {EDGE}, h0 AS (SELECT c_custkey AS id, 0 AS h FROM customer WHERE c_acctbal < 0),
h1 AS (SELECT * FROM h0 UNION ALL SELECT DISTINCT dst, 1 FROM edge WHERE src IN (SELECT id FROM h0) AND dst NOT IN (SELECT id FROM h0)),
h2 AS (SELECT * FROM h1 UNION ALL SELECT DISTINCT dst, 2 FROM edge WHERE src IN (SELECT id FROM h1 WHERE h = 1) AND dst NOT IN (SELECT id FROM h1))
SELECT id AS customer_id, h::INT AS hops FROM h2""")
def hops_from_negative_balance(spark, folder):
    bad = table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("customer_id"))
    return graph.hops_from(_edges(spark, folder), bad, "customer_id", 2)


def embeddings_sql(size: int, rounds: int) -> str:
    """Rounds in fixed point, one row per vertex and component."""
    blocks = " || ".join(f"md5(id || '|42|{b}')" for b in range((size + 31) // 32))
    parts = [f"""seeds AS (SELECT id, {blocks} AS h FROM (SELECT c_custkey AS id FROM customer)),
x0 AS MATERIALIZED (SELECT id, j, CASE WHEN substr(h, j, 1) < '3' THEN {graph.EMBEDDING_ONE} WHEN substr(h, j, 1) < '6' THEN -{graph.EMBEDDING_ONE} ELSE 0 END::BIGINT AS x
  FROM seeds, range(1, {size + 1}) t(j))"""]
    for k in range(rounds):
        parts.append(f"""m{k} AS (SELECT src, j, sum(x) AS s, count(*) AS n FROM edge JOIN x{k} ON id = dst GROUP BY 1, 2),
x{k + 1} AS MATERIALIZED (SELECT x0.id, x0.j, coalesce((s - ((s % n) + n) % n) // n, 0)::BIGINT AS x FROM x0 LEFT JOIN m{k} ON src = x0.id AND m{k}.j = x0.j)""")
    rows = " UNION ALL ".join(f"SELECT id, {k * size} + j AS component, x FROM x{k + 1}" for k in range(rounds))
    return ",\n".join(parts) + f" SELECT id AS customer_id, component::INT AS component, {r6(f'x / {graph.EMBEDDING_ONE}')} AS value FROM ({rows})"


@query("walk_embeddings", f"WITH {EDGE}, {embeddings_sql(64, 3)}")
def walk_embeddings(spark, folder):
    e = graph.walk_embeddings(_edges(spark, folder), _customers(spark, folder), "customer_id")
    flat = e.select("customer_id", F.posexplode("vector").alias("at", "value"))
    return rounded(flat.select("customer_id", (F.col("at") + 1).alias("component"), "value"))


@query("neighbour_mean", f"""
WITH {EDGE}, {LOAN}, a AS (SELECT customer_id, avg(loanAmnt) AS amt, avg(isDefault) AS d FROM loan GROUP BY 1)
SELECT src AS customer_id, {r6('avg(amt)')} AS nb_amt, {r6('avg(d)')} AS nb_d FROM edge JOIN a ON customer_id = dst GROUP BY 1""")
def neighbour_mean(spark, folder):
    f = marts.loans(spark, folder, "customer_id", "loanAmnt", "isDefault").groupBy("customer_id").agg(
        F.avg("loanAmnt").alias("amt"), F.avg("isDefault").alias("d"))
    return rounded(graph.neighbour_mean(_edges(spark, folder), f, "customer_id", ["amt", "d"]))


@query("device_sharing", f"""
WITH {DEVICE}, u AS (SELECT device_id, (count(*) > 1)::INT AS s FROM device GROUP BY 1)
SELECT user_id, count(*) AS n_devices, sum(s)::BIGINT AS n_shared_devices, {r6('sum(s) / (count(*) + 1e-6)')} AS shared_device_ratio
FROM device JOIN u USING (device_id) GROUP BY 1""")
def device_sharing(spark, folder):
    return rounded(graph.device_sharing(marts.device_edges(spark, folder)))


ATTRIBUTES = ["phone", "company", "address", "email", "device", "employer", "bank_card"]


def _applications(spark, folder):
    """Customer as application with seven shareable attributes, some of them missing, and a fraud flag."""
    c = table(spark, folder, "customer")
    d = marts.customer_defaults(spark, folder)
    key = F.col("c_custkey")
    return c.select(
        key.alias("customer_id"), F.round(F.col("c_acctbal") / 10).cast("long").alias("phone"),
        F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("company"),
        F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 25)).alias("address"), (key % 419).alias("email"),
        F.when(key % 3 == 0, key % 50).alias("device"), F.concat_ws("-", F.substring("c_mktsegment", 1, 1), (key % 37).cast("string")).alias("employer"),
        F.when(F.col("c_nationkey") < 9, F.floor(key / 4)).alias("bank_card")).join(d, "customer_id")


APPS = LOAN + ", " + DEFAULTS + """,
app AS (SELECT c_custkey AS id, round(c_acctbal / 10)::BIGINT AS phone, c_nationkey || '-' || c_mktsegment AS company,
  CASE WHEN c_acctbal > 0 THEN floor(c_acctbal / 25) END AS address, c_custkey % 419 AS email, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 END AS device,
  c_mktsegment[1] || '-' || c_custkey % 37 AS employer, CASE WHEN c_nationkey < 9 THEN floor(c_custkey / 4) END AS bank_card, isDefault AS d
  FROM customer JOIN defaults ON customer_id = c_custkey)"""

SAME = " + ".join(f"coalesce((a.{c} = b.{c})::INT, 0)" for c in ATTRIBUTES)


@query("shared_attribute_features", f"""
WITH {APPS}, pr AS (SELECT a.id, b.d, {SAME} AS w FROM app a JOIN app b ON a.id <> b.id AND {SAME} > 0),
g AS (SELECT id, count(*) AS degree, sum(d)::BIGINT AS f, max(w) AS w FROM pr GROUP BY 1)
SELECT app.id AS customer_id, coalesce(degree, 0) AS degree, coalesce(f, 0) AS fraud_neighbor_count, coalesce(w, 0)::INT AS max_edge_weight,
  {r6('coalesce(f / degree, 0)')} AS fraud_neighbor_rate FROM app LEFT JOIN g USING (id)""")
def shared_attribute_features(spark, folder):
    df = hold(_applications(spark, folder))
    return rounded(graph.shared_attribute_features(df, "customer_id", ATTRIBUTES, "isDefault"))


LISTED = " UNION ALL ".join(f"SELECT id, '{c}' AS relation, {c + '::BIGINT' if c in ('address', 'bank_card') else c}::VARCHAR AS value FROM app WHERE {c} IS NOT NULL"
                            for c in ATTRIBUTES)


@query("attribute_ties", f"""
WITH {APPS}, l AS ({LISTED}),
n AS (SELECT *, count(*) OVER (PARTITION BY relation, value) AS sharers FROM l)
SELECT id AS customer_id, relation, value, sharers FROM n WHERE sharers > 1""")
def attribute_ties(spark, folder):
    return graph.attribute_ties(_applications(spark, folder), "customer_id", ATTRIBUTES)


def components_sql(rounds: int = 12) -> str:
    """Unrolled rounds of the smallest label around, enough for this graph's diameter."""
    parts = ["u AS (SELECT c_custkey AS id FROM customer)", "r0 AS (SELECT id, id AS comp FROM u)"]
    for i in range(rounds):
        parts.append(f"r{i + 1} AS MATERIALIZED (SELECT r.id, least(r.comp, coalesce(min(n.comp), r.comp)) AS comp FROM r{i} r LEFT JOIN edge ON src = r.id "
                     f"LEFT JOIN r{i} n ON n.id = dst GROUP BY r.id, r.comp)")
    return ", ".join(parts)


@query("loans_with_graph_features", f"""
WITH {FEATURES}, {TWO_HOP}, {components_sql()}, sz AS (SELECT id, count(*) OVER (PARTITION BY comp) AS component_size FROM r12)
SELECT loan_id, degree AS n_neighbors, coalesce(n, 0) AS n_two_hop_neighbors, {r6('degree / ((SELECT count(*) FROM customer) - 1)')} AS degree_centrality, component_size,
  {r6('CASE WHEN degree > 1 THEN 2 * t / (degree * (degree - 1)) ELSE 0 END')} AS clustering, {r6('bad / greatest(degree, 1)')} AS bad_neighbor_rate, bad AS bad_neighbor_count,
  {r6('wr')} AS weighted_bad_rate, degree - bad AS good_neighbors, mw AS max_edge_weight
FROM loan JOIN feat USING (customer_id) LEFT JOIN far ON v = customer_id JOIN sz ON sz.id = customer_id""")
def loans_with_graph_features(spark, folder):
    """Every loan with all graph features of its customer."""
    features = graph.graph_feature_table(_edges(spark, folder), marts.customer_defaults(spark, folder), "customer_id", "isDefault")
    x = marts.loans(spark, folder, "loan_id", "customer_id")
    return rounded(x.join(features, "customer_id").drop("customer_id"))


@query("connected_components", f"""
WITH {EDGE}, {components_sql()} SELECT id AS customer_id, comp AS component, count(*) OVER (PARTITION BY comp) AS size FROM r12""")
def connected_components(spark, folder):
    return graph.connected_components(_edges(spark, folder), _customers(spark, folder), "customer_id")


def _device_graph(spark, folder):
    """Users joined to the devices of their sign-ups, as one two-sided graph; devices get negative keys."""
    pairs = marts.device_edges(spark, folder).select(F.col("user_id").alias("src"), (-1 - F.col("device_id")).alias("dst"))
    both = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(0.8))
    return hold(both), both.select(F.col("src").alias("node")).distinct()


@query("device_graph_components", f"""
WITH RECURSIVE {DEVICE}, e AS (SELECT user_id AS s, -1 - device_id AS d FROM device UNION SELECT -1 - device_id, user_id FROM device),
w(id, comp) AS (SELECT DISTINCT s, s FROM e UNION SELECT e.d, w.comp FROM w JOIN e ON e.s = w.id)
SELECT id AS node, min(comp) AS component, count(*) OVER (PARTITION BY min(comp)) AS size FROM w GROUP BY 1""")
def device_graph_components(spark, folder):
    edges, nodes = _device_graph(spark, folder)
    return graph.connected_components(edges, nodes, "node")


@query("dense_components", f"""
WITH {EDGE}, {components_sql()}, s AS (SELECT comp, count(*) AS size FROM r12 GROUP BY 1 HAVING count(*) >= 3),
d AS (SELECT comp AS component, size, (SELECT count(*) FROM edge JOIN r12 ON id = src WHERE r12.comp = s.comp) / (size * (size - 1)) AS density FROM s)
SELECT component, size, {r6('density')} AS density FROM d WHERE density > 0.5""")
def dense_components(spark, folder):
    e = _edges(spark, folder)
    comps = graph.connected_components(e, _customers(spark, folder), "customer_id")
    return rounded(graph.dense_components(e, comps, "customer_id"))


def communities_sql(rounds: int = 5) -> str:
    parts = ["s0 AS (SELECT c_custkey AS id, c_custkey AS comm FROM customer)"]
    for i in range(rounds):
        parts.append(f"""v{i} AS (SELECT src, comm, round(sum(weight), 9) AS w FROM edge JOIN s{i} ON id = dst GROUP BY 1, 2),
b{i} AS (SELECT src, comm FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, comm) AS k FROM v{i}) WHERE k = 1),
s{i + 1} AS MATERIALIZED (SELECT s{i}.id, coalesce(b{i}.comm, s{i}.comm) AS comm FROM s{i} LEFT JOIN b{i} ON src = id)""")
    return ", ".join(parts)


@query("label_communities", f"WITH {EDGE}, {communities_sql()} SELECT id AS customer_id, comm AS community FROM s5")
def label_communities(spark, folder):
    return graph.label_communities(_edges(spark, folder), _customers(spark, folder), "customer_id")


@query("community_risk", f"""
WITH {EDGE}, {LOAN}, {DEFAULTS}, {communities_sql()}
SELECT comm AS community, count(*) AS size, sum(isDefault)::BIGINT AS bad, {r6('avg(isDefault)')} AS bad_rate FROM s5 JOIN defaults ON customer_id = id
GROUP BY 1 HAVING count(*) >= 3""")
def community_risk(spark, folder):
    d = marts.customer_defaults(spark, folder)
    comm = graph.label_communities(_edges(spark, folder), d.select("customer_id"), "customer_id")
    return rounded(graph.community_risk(comm, d, "customer_id", "isDefault"))


#: customers in blocks of twelve: eight that are mostly tied to each other, in every second block with a chain of three behind them
TIED = """((p < 8 AND q < 8 AND (block % 3 > 0 OR (p + q) % 2 > 0)) OR (block % 2 = 0 AND q = p + 1 AND p BETWEEN 7 AND 9))"""


@query("dense_blocks", f"""
WITH RECURSIVE c AS (SELECT c_custkey AS id, c_custkey // 12 AS block, c_custkey % 12 AS p FROM customer),
half AS (SELECT a.id AS src, b.id AS dst FROM c a JOIN (SELECT id, block, p AS q FROM c) b USING (block) WHERE p < q AND {TIED}),
e AS (SELECT * FROM half UNION ALL SELECT dst, src FROM half),
w(id, comp) AS (SELECT id, id FROM c UNION SELECT e.dst, w.comp FROM w JOIN e ON e.src = w.id),
k AS (SELECT id, min(comp) AS comp FROM w GROUP BY 1), s AS (SELECT comp, count(*) AS size FROM k GROUP BY 1 HAVING count(*) >= 3),
d AS (SELECT comp, size, (SELECT count(*) FROM e JOIN k ON k.id = e.src WHERE k.comp = s.comp) / (size * (size - 1)) AS density FROM s),
near AS (SELECT id, id AS far FROM k UNION SELECT src, dst FROM e UNION SELECT a.src, b.dst FROM e a JOIN e b ON a.dst = b.src
  UNION SELECT a.src, g.dst FROM e a JOIN e b ON a.dst = b.src JOIN e g ON b.dst = g.src),
reach AS (SELECT comp, min(n) AS n FROM (SELECT id, count(*) AS n FROM near GROUP BY 1) JOIN k USING (id) GROUP BY 1)
SELECT comp AS component, size, {r6('density')} AS density FROM d JOIN reach USING (comp) WHERE density > 0.5 AND n = size""")
def dense_blocks(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 12).alias("block"), (F.col("c_custkey") % 12).alias("p"))
    half = c.join(c.select(F.col("id").alias("dst"), "block", F.col("p").alias("q")), "block").where(f"p < q AND {TIED}").select(F.col("id").alias("src"), "dst")
    e = hold(half.unionByName(half.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    comps = graph.connected_components(e, c, "id")
    return rounded(graph.dense_components(e, comps, "id"))


def page_rank_sql(rounds: int) -> str:
    parts = ["v AS (SELECT c_custkey AS id, (SELECT count(*) FROM customer) AS n FROM customer)", "dg AS (SELECT src, count(*) AS deg FROM edge GROUP BY 1)",
             "p0 AS (SELECT id, n, 1 / n AS rank FROM v)"]
    for i in range(rounds):
        parts.append(f"f{i} AS MATERIALIZED (SELECT v.id, v.n, coalesce(sum(p.rank / deg), 0) AS inn FROM v LEFT JOIN edge ON dst = v.id LEFT JOIN p{i} p ON p.id = edge.src "
                     f"LEFT JOIN dg ON dg.src = edge.src GROUP BY v.id, v.n)")
        parts.append(f"p{i + 1} AS MATERIALIZED (SELECT id, n, 0.15 / n + 0.85 * (inn + (1 - (SELECT sum(inn) FROM f{i})) / n) AS rank FROM f{i})")
    return ", ".join(parts)


@query("page_rank", f"WITH {EDGE}, {page_rank_sql(30)} SELECT id AS customer_id, round(rank, 7) AS rank FROM p30")
def page_rank(spark, folder):
    out = graph.page_rank(_edges(spark, folder), _customers(spark, folder), "customer_id")
    return out.select("customer_id", F.round("rank", 7).alias("rank"))


def walks_sql(length: int = 5) -> str:
    parts = [f"""nb AS MATERIALIZED (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY {uniform('dst', 'neighbour')}, md5(dst::VARCHAR)) - 1 AS i,
  count(*) OVER (PARTITION BY src) AS deg FROM edge), w0 AS (SELECT c_custkey AS start, c_custkey AS node, c_custkey::VARCHAR AS path FROM customer)"""]
    for step in range(length - 1):
        parts.append(f"""w{step + 1} AS MATERIALIZED (SELECT start, coalesce(dst, node) AS node, CASE WHEN dst IS NULL THEN path ELSE path || '>' || dst END AS path
  FROM w{step} LEFT JOIN nb ON src = node AND i = {uniform(f"start || '|1|{step}'", 42)} % deg)""")
    return ", ".join(parts)


@query("random_walks", f"WITH {EDGE}, {walks_sql()} SELECT start AS customer_id, 1 AS walk, path FROM w4")
def random_walks(spark, folder):
    w = graph.random_walks(_edges(spark, folder), _customers(spark, folder), "customer_id")
    return w.select("customer_id", "walk", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))
