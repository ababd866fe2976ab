"""The metric registry as data: which raw metric of which provider feeds which canonical feature."""

#: Category -> feature -> provider -> (raw metric, transform) in order of precedence.
#: i keeps a value, p keeps a percentage, inv is 100 minus the value.
REGISTRY = {
    "Compute": {
        "canonical_cpu_pct": {"AWS": [("CPUUtilization", "p")], "Azure": [("Percentage CPU", "p")], "GCP": [("compute.googleapis.com/instance/cpu/utilization", "p")], "OCI": [("CpuUtilization", "p")]},
        "canonical_cpu_idle_pct": {"AWS": [("cpu_usage_idle", "p")], "Azure": [("Percentage CPU", "inv")], "GCP": [("compute.googleapis.com/instance/cpu/utilization", "inv")]},
        "canonical_iowait_pct": {"AWS": [("cpu_usage_iowait", "p")]},
        "canonical_mem_used_pct": {"AWS": [("mem_used_percent", "p")], "GCP": [("agent.googleapis.com/memory/percent_used", "p")], "OCI": [("MemoryUtilization", "p")]},
        "canonical_swap_used_pct": {"AWS": [("swap_used_percent", "p")]},
        "canonical_disk_read_bytes": {"AWS": [("DiskReadBytes", "i")], "Azure": [("Disk Read Bytes", "i"), ("OS Disk Read Bytes/sec", "i"), ("Data Disk Read Bytes/sec", "i")], "GCP": [("compute.googleapis.com/instance/disk/read_bytes_count", "i")], "OCI": [("DiskBytesRead", "i")]},
        "canonical_disk_write_bytes": {"AWS": [("DiskWriteBytes", "i")], "Azure": [("Disk Write Bytes", "i"), ("OS Disk Write Bytes/sec", "i"), ("Data Disk Write Bytes/sec", "i")], "GCP": [("compute.googleapis.com/instance/disk/write_bytes_count", "i")], "OCI": [("DiskBytesWritten", "i")]},
        "canonical_disk_read_iops": {"AWS": [("DiskReadOps", "i")], "Azure": [("Disk Read Operations/Sec", "i"), ("OS Disk Read Operations/Sec", "i"), ("Data Disk Read Operations/Sec", "i")], "OCI": [("DiskIopsRead", "i")]},
        "canonical_disk_write_iops": {"AWS": [("DiskWriteOps", "i")], "Azure": [("Disk Write Operations/Sec", "i"), ("OS Disk Write Operations/Sec", "i"), ("Data Disk Write Operations/Sec", "i")], "OCI": [("DiskIopsWritten", "i")]},
        "canonical_disk_used_pct": {"AWS": [("disk_used_percent", "p")], "Azure": [(r"\LogicalDisk(_Total)\% Free Space", "inv"), ("disk/free_percent", "inv")]},
        "canonical_net_in_bytes": {"AWS": [("NetworkIn", "i"), ("NetworkPacketsIn", "i")], "Azure": [("Network In Total", "i"), ("Network In", "i")], "GCP": [("compute.googleapis.com/instance/network/received_bytes_count", "i")], "OCI": [("NetworksBytesIn", "i")]},
        "canonical_net_out_bytes": {"AWS": [("NetworkOut", "i"), ("NetworkPacketsOut", "i")], "Azure": [("Network Out Total", "i"), ("Network Out", "i")], "GCP": [("compute.googleapis.com/instance/network/sent_bytes_count", "i")], "OCI": [("NetworksBytesOut", "i")]},
        "status_check_failed": {"AWS": [("StatusCheckFailed", "i"), ("StatusCheckFailed_Instance", "i"), ("StatusCheckFailed_System", "i")]},
        "lambda_throttles": {"AWS": [("Throttles", "i")]},
        "lambda_concurrent_executions": {"AWS": [("ConcurrentExecutions", "i")]},
        "lambda_invocations": {"AWS": [("Invocations", "i")]},
        "lambda_errors": {"AWS": [("Errors", "i")]},
        "lambda_duration_ms": {"AWS": [("Duration", "i")]},
        "cpu_credit_balance": {"AWS": [("CPUCreditBalance", "i")], "Azure": [("CPU Credits Remaining", "i")]},
        "cpu_credit_usage": {"AWS": [("CPUCreditUsage", "i")]},
        "cpu_surplus_credit_balance": {"AWS": [("CPUSurplusCreditBalance", "i")]},
        "cpu_surplus_credits_charged": {"AWS": [("CPUSurplusCreditsCharged", "i")]},
        "load_average": {"OCI": [("LoadAverage", "i")]},
    },
    "Network": {
        "canonical_net_in_bytes": {"AWS": [("BytesIn", "i"), ("PacketsIn", "i")], "Azure": [("ByteCount", "i"), ("PEBytesIn", "i"), ("PacketCount", "i")], "GCP": [("networking.googleapis.com/vm_flow/ingress_bytes_count", "i")]},
        "canonical_net_out_bytes": {"AWS": [("BytesOut", "i"), ("PacketsOut", "i")], "Azure": [("PEBytesOut", "i")], "GCP": [("networking.googleapis.com/vm_flow/egress_bytes_count", "i")]},
        "canonical_active_connections": {"AWS": [("ActiveConnectionCount", "i")], "Azure": [("TotalConnectionCount", "i")]},
        "canonical_health_pct": {"AWS": [("HealthCheckPercentageHealthy", "p")], "Azure": [("VipAvailability", "p"), ("DipAvailability", "p")]},
        "canonical_health_status": {"AWS": [("HealthCheckStatus", "i")]},
        "canonical_ddos_signal": {"AWS": [("PacketDropCountBlackhole", "i"), ("PacketDropCountNoRoute", "i")], "Azure": [("IfUnderDDoSAttack", "i"), ("PacketsInDDoS", "i"), ("BytesInDDoS", "i"), ("PacketsDroppedDDoS", "i"), ("TCPPacketsInDDoS", "i"), ("UDPPacketsInDDoS", "i"), ("SynCount", "i")]},
        "canonical_subnet_util_pct": {"Azure": [("VirtualNetworkLinkCapacityUtilization", "p"), ("RecordSetCapacityUtilization", "p")], "OCI": [("SubnetIpUtilization", "p")]},
        "canonical_flow_log_count": {"GCP": [("networking.googleapis.com/vpc_flow/predicted_max_vpc_flow_logs_count", "i")]},
        "canonical_dns_queries": {"AWS": [("InboundQueryVolume", "i")], "Azure": [("QueryVolume", "i")]},
        "canonical_throughput": {"AWS": [("Throughput", "i")]},
        "canonical_probe_failure_count": {"GCP": [("networking.googleapis.com/cloud_netslo/active_probing/probe_count", "i")]},
    },
    "Storage": {
        "canonical_storage_read_bytes": {"AWS": [("VolumeReadBytes", "i"), ("DataReadIOBytes", "i")], "Azure": [("Composite Disk Read Bytes/sec", "i"), ("Ingress", "i")], "GCP": [("storage.googleapis.com/network/received_bytes_count", "i")], "OCI": [("FileSystemReadThroughput", "i")]},
        "canonical_storage_write_bytes": {"AWS": [("VolumeWriteBytes", "i"), ("DataWriteIOBytes", "i")], "Azure": [("Composite Disk Write Bytes/sec", "i"), ("Egress", "i")], "GCP": [("storage.googleapis.com/network/sent_bytes_count", "i")], "OCI": [("FileSystemWriteThroughput", "i")]},
        "canonical_storage_read_iops": {"AWS": [("VolumeReadOps", "i")], "Azure": [("Composite Disk Read Operations/sec", "i")], "GCP": [("storage.googleapis.com/api/request_count", "i")], "OCI": [("MetadataIOPS", "i")]},
        "canonical_storage_write_iops": {"AWS": [("VolumeWriteOps", "i")], "Azure": [("Composite Disk Write Operations/sec", "i")], "GCP": [("storage.googleapis.com/api/request_count", "i")], "OCI": [("MetadataIOPS", "i")]},
        "canonical_storage_used_pct": {"AWS": [("PercentIOLimit", "p")], "OCI": [("FileSystemUsage", "p")]},
        "canonical_storage_capacity_raw": {"AWS": [("BucketSizeBytes", "i")], "Azure": [("UsedCapacity", "i")], "GCP": [("storage.googleapis.com/storage/total_byte_seconds", "i")]},
        "canonical_storage_latency_ms": {"AWS": [("VolumeTotalReadTime", "i"), ("VolumeTotalWriteTime", "i")], "Azure": [("SuccessE2ELatency", "i"), ("SuccessServerLatency", "i")]},
        "canonical_queue_depth": {"AWS": [("VolumeQueueLength", "i")]},
        "canonical_storage_transactions": {"Azure": [("Transactions", "i")]},
        "canonical_volume_idle_time": {"AWS": [("VolumeIdleTime", "i")]},
        "canonical_permitted_throughput": {"AWS": [("PermittedThroughput", "i")]},
        "canonical_burst_balance_pct": {"AWS": [("BurstBalance", "p")]},
        "canonical_credit_balance_raw": {"AWS": [("BurstCreditBalance", "i")]},
        "availability_pct": {"Azure": [("Availability", "p")]},
        "backup_health_event": {"Azure": [("BackupHealthEvent", "i")]},
    },
    "Container": {
        "canonical_node_cpu_pct": {"Azure": [("node_cpu_usage_percentage", "p")]},
        "canonical_node_cpu_millicores": {"Azure": [("node_cpu_usage_millicores", "i")]},
        "canonical_node_mem_pct": {"Azure": [("node_memory_working_set_percentage", "p"), ("node_memory_rss_percentage", "p")]},
        "canonical_node_mem_bytes": {"Azure": [("node_memory_working_set_bytes", "i"), ("node_memory_rss_bytes", "i"), ("kube_node_status_allocatable_memory_bytes", "i")]},
        "canonical_node_disk_pct": {"Azure": [("node_disk_usage_percentage", "p")]},
        "canonical_node_disk_bytes": {"Azure": [("node_disk_usage_bytes", "i")]},
        "canonical_node_net_in_bytes": {"Azure": [("node_network_in_bytes", "i")]},
        "canonical_node_net_out_bytes": {"Azure": [("node_network_out_bytes", "i")]},
        "canonical_pod_ready": {"Azure": [("kube_pod_status_ready", "i"), ("kube_pod_status_phase", "i")]},
        "canonical_unschedulable_pods": {"Azure": [("cluster_autoscaler_unschedulable_pods_count", "i")]},
        "canonical_unneeded_nodes": {"Azure": [("cluster_autoscaler_unneeded_nodes_count", "i")]},
        "canonical_api_inflight_requests": {"Azure": [("apiserver_current_inflight_requests", "i")]},
        "canonical_allocatable_cpu_cores": {"Azure": [("kube_node_status_allocatable_cpu_cores", "i")]},
        "canonical_node_condition": {"Azure": [("kube_node_status_condition", "i")]},
        "canonical_storage_used_bytes": {"Azure": [("StorageUsed", "i")]},
    },
    "Databases": {
        "canonical_db_cpu_pct": {"AWS": [("CPUUtilization", "p"), ("EngineCPUUtilization", "p")], "Azure": [("cpu_percent", "p"), ("dtu_consumption_percent", "p")]},
        "canonical_db_mem_pct": {"AWS": [("DatabaseMemoryUsagePercentage", "p")], "Azure": [("memory_percent", "p")]},
        "canonical_db_storage_pct": {"Azure": [("storage_percent", "p")]},
        "canonical_db_storage_bytes": {"Azure": [("storage", "i")], "AWS": [("allocated_data_storage", "i")]},
        "canonical_db_connections": {"Azure": [("active_connections", "i"), ("sessions_count", "i")]},
        "canonical_db_dtu_used": {"Azure": [("dtu_used", "i")]},
        "canonical_db_read_capacity": {"AWS": [("ConsumedReadCapacityUnits", "i"), ("ProvisionedReadCapacityUnits", "i")]},
        "canonical_db_write_capacity": {"AWS": [("ConsumedWriteCapacityUnits", "i"), ("ProvisionedWriteCapacityUnits", "i")]},
        "canonical_db_net_in_bytes": {"AWS": [("NetworkBytesIn", "i")]},
        "canonical_db_blocked_by_firewall": {"Azure": [("blocked_by_firewall", "i")]},
    },
    "Governance": {
        "canonical_cpu_pct": {"AWS": [("CPUUtilization", "p")], "Azure": [("Percentage CPU", "p"), ("IntegrationRuntimeCpuPercentage", "p")]},
        "canonical_mem_used_pct": {"AWS": [("mem_used_percent", "p")], "Azure": [("MemoryUsage", "p"), ("AverageMemoryWorkingSet", "i")]},
        "canonical_runs_failed": {"Azure": [("RunsFailed", "i"), ("ActivityFailedRuns", "i"), ("PipelineFailedRuns", "i"), ("TriggerFailedRuns", "i")]},
        "canonical_runs_succeeded": {"Azure": [("RunsCompleted", "i"), ("ActivitySucceededRuns", "i"), ("PipelineSucceededRuns", "i")]},
        "canonical_run_failure_pct": {"Azure": [("RunFailurePercentage", "p")]},
        "canonical_run_duration_ms": {"Azure": [("RunDuration", "i"), ("RunLatency", "i")]},
        "canonical_group_instances": {"AWS": [("GroupInServiceInstances", "i"), ("GroupTotalInstances", "i"), ("GroupDesiredCapacity", "i")]},
        "canonical_group_capacity": {"AWS": [("GroupInServiceCapacity", "i"), ("GroupTotalCapacity", "i")]},
        "canonical_throttled_requests": {"AWS": [("ThrottledRequests", "i")], "Azure": [("ThrottledRequests", "i")]},
        "canonical_status_check_failed": {"AWS": [("StatusCheckFailed", "i"), ("StatusCheckFailed_Instance", "i"), ("StatusCheckFailed_System", "i")]},
        "canonical_integration_queue_length": {"Azure": [("IntegrationRuntimeQueueLength", "i")]},
        "canonical_resource_count": {"Azure": [("ResourceCount", "i")]},
    },
    "Security": {
        "canonical_api_hit": {"Azure": [("ServiceApiHit", "i")]},
        "canonical_api_latency_ms": {"Azure": [("ServiceApiLatency", "i")]},
        "canonical_api_result": {"Azure": [("ServiceApiResult", "i")]},
        "canonical_saturation": {"Azure": [("SaturationShoebox", "i")]},
        "canonical_availability_pct": {"Azure": [("Availability", "p")]},
    },
}


def rules() -> list[tuple[str, str, str, str, str, int]]:
    """(category, feature, provider, raw metric, transform, precedence), precedence from 0 in each feature and provider."""
    return [(c, f, p, m, kind, k) for c, features in REGISTRY.items() for f, providers in features.items() for p, many in providers.items() for k, (m, kind) in enumerate(many)]
