"""Spellings, types and thresholds of the telemetry domain."""

#: Categories that are processed.
LIVE_CATEGORIES = ["Storage", "Compute", "Network", "Container", "Databases"]

#: Spellings of each category, in lower case.
CATEGORY_SPELLINGS = {
    "Compute": ["compute", "virtual_machines", "vm_instances", "virtual_machine_scale_sets", "web_apps", "appservice_plan"],
    "Network": ["network", "networking", "application_gateway", "load_balancer", "nat_gateways", "subnets", "private_endpoints", "private_dns_zones", "public_ip_address", "routes", "resolver_inbound_endpoint", "transit_gateways", "transit_gateway_attachments"],
    "Storage": ["storage", "storage_accounts", "file_systems", "volumes", "table"],
    "Container": ["container", "containers"],
    "Databases": ["database", "databases", "ms-sql_db", "mariadb"],
}
CATEGORY_ALIASES = {alias: name for name, many in CATEGORY_SPELLINGS.items() for alias in many}

#: Spellings of each provider, in lower case.
PROVIDER_SPELLINGS = {
    "AWS": ["aws", "amazon", "amazon web services"],
    "Azure": ["azure", "microsoft azure"],
    "GCP": ["gcp", "google", "google cloud", "google cloud platform"],
    "OCI": ["oci", "oracle", "oracle cloud"],
}
PROVIDER_ALIASES = {alias: name for name, many in PROVIDER_SPELLINGS.items() for alias in many}

#: Components of each resource type.
TYPE_COMPONENTS = {
    "vm_instance": ["Compute", "Compute_Engine", "EC2", "Virtual_Machines"],
    "serverless_function": ["Lambda"],
    "vpc_network": ["VPC", "Virtual_Networks", "Virtual_Cloud_Networks"],
    "block_storage": ["EBS", "Storage_Disks"],
    "object_storage": ["S3", "Bucket"],
    "file_storage": ["EFS", "File_Storage"],
    "nosql_kv_store": ["DynamoDB"],
    "relational_generic_db": ["Databases", "Servers"],
    "dns": ["Route53", "Route53_Resolver", "Private_DNS_Zones"],
    "in_memory_cache": ["ElastiCache"],
    "load_balancer": ["Load_Balancers", "Application_Gateway"],
    "private_link_endpoint": ["Azure_Private_Link"],
    "storage_account": ["Accounts"],
    "backup_recovery_vault": ["Recovery_Services"],
    "container_registry": ["Container_Registry"],
    "k8s_cluster": ["Azure_Kubernetes_Service"],
}
COMPONENT_TYPES = {c: t for t, many in TYPE_COMPONENTS.items() for c in many}

#: Keys of a reading, the first that holds a number wins.
STAT_PRIORITY = ["average", "delta", "maximum", "sum", "total", "minimum", "count", "samplecount", "value"]

#: Severity by risk, then the channel of each severity.
SEVERITIES = [(90, "CRITICAL"), (75, "HIGH"), (50, "WARNING")]
CHANNELS = {"CRITICAL": "pagerduty", "HIGH": "pagerduty", "WARNING": "slack"}
BADGES = [(75, "red"), (50, "amber"), (25, "blue")]

#: Weights of the confidence score.
RELIABILITY_WEIGHTS = {"high": 0.9, "medium-high": 0.75, "medium": 0.6, "moderate": 0.6, "low": 0.3}
METHOD_WEIGHTS = {"stl_decomposition": 0.95, "linear_regression_bootstrap": 0.85, "exponential_smoothing": 0.8, "shrunk_slope_xgboost_prior": 0.7, "pooled_type_prior": 0.65, "flat_signal": 0.4}

#: Pairs of categories and what they suggest, the first that holds wins.
COMPOSITE_CAUSES = [("Compute", "Network"), ("Compute", "Storage"), ("Storage", "Databases"), ("Network", "Security"), ("Container", "Compute"), ("Databases", "Compute")]

#: Display thresholds (warn, critical, low is bad) of digests.
DIGEST_THRESHOLDS = {
    "canonical_cpu_pct": (80, 90, False), "canonical_mem_used_pct": (80, 90, False), "canonical_storage_used_pct": (80, 90, False),
    "canonical_node_cpu_pct": (80, 90, False), "canonical_node_mem_pct": (80, 90, False), "canonical_db_cpu_pct": (80, 90, False),
    "canonical_db_mem_pct": (80, 90, False), "canonical_db_storage_pct": (85, 95, False), "canonical_saturation": (75, 90, False),
    "canonical_subnet_util_pct": (75, 90, False), "canonical_burst_balance_pct": (20, 10, True), "canonical_health_pct": (90, 80, True),
    "availability_pct": (99, 95, True),
}
