"""What several test modules use."""

HOST_SCHEMA = (
    "datacenter string, cluster_id string, cluster string, gluster_enabled boolean, address string, "
    "is_spm boolean, is_up boolean"
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
