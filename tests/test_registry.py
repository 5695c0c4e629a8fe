"""The registry's rules, one by one and in conflict."""

from rootline.operators import registry


def test_every_rule_and_the_longest(spark, tmp_path):
    known = registry.read(spark)
    rows = registry.bundled()
    pods = [n for k, n, *_ in rows if k == "pod"]
    longest = {p: max((n for n in pods if f"{p}x".startswith(n)), key=len) for p in pods}
    value = {(k, n): v for k, n, v, _ in rows}
    given = [(p, None, f"{p}X".upper()) for p in pods] + [(n, f" {n.upper()} ", "zzz") for k, n, *_ in rows if k == "namespace"] + [("none", "nowhere", None), ("null", None, None)]
    df = spark.createDataFrame([(*g, 1) for g in given], "id string, namespace string, pod string, value int")
    got = {(r.id, r.pod): r.pod_subsystem for r in registry.pod_subsystems(df, known).collect()}
    for i, _, pod in given:
        want = value["pod", longest[i]] if i in longest and pod and pod != "zzz" else value.get(("namespace", i), "unknown_asup_subsystem")
        assert got[i, pod] == want, i
    (tmp_path / "own.tsv").write_text("# own\npod\tab\tone\t\npod\tabc\ttwo\t\nnamespace\tns\tspace\t\n")
    own = registry.read(spark, str(tmp_path / "own.tsv"))
    df = spark.createDataFrame([("ns", "abcd"), ("ns", "abd"), ("ns", "x"), ("y", "ABC")], "namespace string, pod string")
    assert [r.pod_subsystem for r in registry.pod_subsystems(df, own).orderBy("pod").collect()] == ["two", "two", "one", "space"]


def test_components_and_owners(spark):
    known = registry.read(spark)
    df = spark.createDataFrame(
        [("a", "vault", None, None, None), ("b", "vault", "prometheus-0", "sidecar", None), ("c", "none", "x", None, {"app": "kyverno"}), ("d", None, "milvus-etcd-0", "etcd", None), ("e", "none", "", " ", None)],
        "id string, namespace string, pod string, container string, labels map<string,string>",
    )
    got = {r.id: (r.subsystem, r.component, r.domain) for r in registry.component_subsystems(df, known, labels="labels").collect()}
    assert got == {"a": ("policy", "unknown_component", None), "b": ("observability", "prometheus", "observability"), "c": ("policy", "kyverno", "policy"), "d": ("data_platform", "milvus-core", "data_platform"), "e": ("unknown_subsystem", "unknown_component", None)}
    owned = registry.owners(spark.createDataFrame([("system:node:n1", ""), ("web", "ask the kafka-exporter"), (None, None)], "service string, raw string"), known, text="raw")
    assert {r.service: (r.component, r.domain, r.system, r.owner_hint) for r in owned.collect()} == {
        "system:node:n1": ("kubelet", "node", "k8s_nodes", "platform_sre"), "web": ("kafka", "data_platform", "data_platform", "data_platform_team"), None: ("unknown_component", "unknown_domain", "unknown_system", "unknown_owner"),
    }
