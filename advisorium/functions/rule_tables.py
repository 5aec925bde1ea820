"""Rule tables of the curation jobs: fixed values only, no logic.

The jobs take their rules as parameters; these are the standard ones.
"""

from advisorium.functions.rules import Outcome, PatternRule

# Service classification patterns, first matching rule wins.
SERVICE_RULES = (
    PatternRule("ec2", (
        r"\bec2\b", r"\binstance\b", r"\bami\b", r"\bplacement group\b", r"\belastic ip\b",
        r"\beip\b", r"\beni\b", r"\bauto.?scaling\b", r"\basg\b", r"\bspot\b",
        r"\breserved instance\b", r"\bnitro\b", r"\bboot time\b", r"\bmulti.?threading\b",
        r"\bcore count\b", r"\bgolden image\b")),
    PatternRule("ebs", (
        r"\bebs\b", r"\bvolume\b", r"\biops\b", r"\braid\b", r"\bsnapshot\b",
        r"\broot volume\b", r"\bmulti.?attach\b")),
    PatternRule("s3", (
        r"\bs3\b(?!\s*bucket)", r"s3 bucket", r"\bbucket\b", r"\bglacier\b", r"\bs3ia\b",
        r"\bpresigned\b", r"\bversioning\b.*s3", r"s3.*versioning", r"s3.*encryption",
        r"s3.*logging", r"s3.*acl", r"s3.*ssl", r"s3.*sse", r"s3.*public", r"s3.*replication",
        r"s3.*crr", r"s3.*select", r"s3.*transfer acceleration")),
    PatternRule("rds", (
        r"\brds\b", r"\baurora\b", r"\bread replica\b", r"\bdatabase\b.*sql", r"sql.*database",
        r"\bserverless v[12]\b", r"\bparameter group\b", r"db instance", r"analytics.*rds",
        r"rds.*analytics")),
    PatternRule("dynamodb", (
        r"\bdynamodb\b", r"\bdynamo\b", r"\bdax\b", r"\brcu\b", r"\bwcu\b", r"\bhot.?key\b",
        r"\bhot.?shard\b", r"\bglobal table\b", r"provisioned.*throughput")),
    PatternRule("lambda", (
        r"\blambda\b(?!.*cloudfront)", r"serverless.*function", r"lambda.*admin",
        r"lambda.*execution role", r"lambda.*ram", r"lambda.*invoked")),
    PatternRule("cloudfront", (
        r"\bcloudfront\b", r"\bcdn\b", r"\bedge location\b", r"\bsigned url\b.*cloudfront",
        r"cloudfront.*signed", r"\bsigned cookie\b", r"\bgeo restriction\b", r"\btls\b.*cdn",
        r"cdn.*tls", r"origin.*cloudfront")),
    PatternRule("alb/elb", (
        r"\belb\b", r"\balb\b", r"\bnlb\b", r"\bload.?balancer\b", r"health.?check.*elb",
        r"elb.*health", r"listener.*certificate", r"elb.*ssl", r"ssl.*elb", r"elb.*cipher",
        r"elb.*access log")),
    PatternRule("networking", (
        r"\bvpc\b", r"\bsubnet\b", r"\bnat gateway\b", r"\bnat instance\b",
        r"\bdirect connect\b", r"\bflow log\b", r"\btransit gateway\b", r"\bprivate link\b",
        r"\bvpc peering\b", r"\bvpc endpoint\b", r"\bglobal accelerator\b",
        r"security group.*vpc", r"vpc.*security")),
    PatternRule("networking", (
        r"\bsecurity group\b", r"\bingress\b.*0\.0\.0\.0", r"\bssh\b.*port", r"\brdp\b.*port",
        r"default.*security group")),
    PatternRule("iam", (
        r"\biam\b", r"\brole\b.*aws", r"aws.*role", r"\bmfa\b", r"\broot\b.*account",
        r"\baccess key\b", r"\bpassword policy\b", r"\bcredential\b.*report",
        r"\bleast privilege\b", r"inline.?policy", r"\*:\*", r"\biam user\b")),
    PatternRule("cloudtrail", (
        r"\bcloudtrail\b", r"\btrail\b.*multi.?region", r"multi.?region.*trail",
        r"trail.*log")),
    PatternRule("cloudwatch", (
        r"\bcloudwatch\b(?!.*cloudtrail)", r"\balarm\b.*metric", r"metric.*alarm",
        r"\bcost.?explorer\b")),
    PatternRule("efs", (
        r"\befs\b", r"\bfile.?system\b.*amazon", r"amazon.*file.?system", r"efs.*encrypt")),
    PatternRule("ecs", (
        r"\becs\b", r"\bcontainer\b.*aws", r"aws.*container", r"\bfargate\b", r"ecs.*encrypt",
        r"ecs.*cluster")),
    PatternRule("route 53", (
        r"\broute\s*53\b", r"\bdns\b", r"routing.?policy", r"\bgeolocation\b.*routing",
        r"weighted.*routing", r"\blatency\b.*routing", r"health.?check.*route")),
    PatternRule("kinesis", (
        r"\bkinesis\b", r"\bdata.?stream\b", r"\bfirehose\b", r"video.?stream")),
    PatternRule("sqs", (
        r"\bsqs\b", r"\bqueue\b.*message", r"message.*queue", r"\bvisibility.?timeout\b")),
    PatternRule("sns", (
        r"\bsns\b", r"\btopic\b.*subscriber", r"subscriber.*topic")),
    PatternRule("elasticache", (
        r"\belasticache\b", r"\bredis\b", r"\bmemcached\b", r"\bcache\b.*aws",
        r"sorted.?set.*redis")),
    PatternRule("kms", (
        r"\bkms\b", r"\bcmk\b", r"\bencryption.?key\b", r"customer.?master.?key",
        r"key.?rotation")),
    PatternRule("inspector", (r"\binspector\b",)),
    PatternRule("aws-config", (r"\baws.?config\b", r"config.*enabled.*region")),
    PatternRule("fsx", (r"\bfsx\b", r"\bluster\b", r"windows.*file.?share")),
    PatternRule("storage-gateway", (
        r"\bstorage.?gateway\b", r"file.?gateway", r"volume.?gateway", r"tape.?gateway")),
    PatternRule("snow", (
        r"\bsnow\b", r"\bsnowball\b", r"\bsnowcone\b", r"\bsnowmobile\b")),
    PatternRule("api-gateway", (
        r"\bapi.?gateway\b", r"edge.?optimized.*api", r"private.*api.*gateway",
        r"api.*gateway.*cache")),
    PatternRule("acm", (
        r"\bcertificate\b.*expir", r"ssl.*certificate.*expir", r"tls.*certificate.*expir")),
)

# Patterns of entries that belong to no single service.
GENERAL_PATTERNS = (
    r"savings.?plan", r"\bfinops\b", r"cost.?allocation.?tag", r"decommission", r"\bbudget\b",
    r"cost.?model", r"cost.?aware", r"shared.?resource", r"shared.?infrastructure",
    r"managed.?service.*vs", r"cloud.?financial", r"organization.?wide", r"cross.?service",
)

# Words that mark an idle resource, and words that set the effort.
IDLE_WORDS = ("idle", "unused", "unattached", "orphan")
HIGH_EFFORT_WORDS = ("migration", "refactor", "architecture", "redesign")
LOW_EFFORT_WORDS = ("enable", "configure", "tag", "update", "delete", "remove", "disable")

# Alert criteria by risk and scenario keyword, full table.
ALERT_OUTCOMES = (
    Outcome("idle", ("ebs", "volume"), "EBS volume has been unattached for more than 7 days"),
    Outcome("idle", ("elastic ip", "eip"), "Elastic IP is not associated with any running instance"),
    Outcome("idle", ("load balancer", "elb", "alb"),
            "Load balancer has received less than 100 requests in the past 7 days"),
    Outcome("idle", ("ec2", "instance"),
            "EC2 instance CPU utilization has been below 5% for the past 14 days"),
    Outcome("idle", ("nat",), "NAT Gateway has processed less than 1GB of data in the past 30 days"),
    Outcome("idle", ("rds", "database"), "RDS instance has had zero connections for the past 7 days"),
    Outcome("idle", (), "Resource has been idle or unused for an extended period"),
    Outcome("security", ("encrypt",), "Resource is not encrypted or uses outdated encryption"),
    Outcome("security", ("public",), "Resource is publicly accessible when it should not be"),
    Outcome("security", ("password", "credential"),
            "Credentials are not rotated within the recommended period"),
    Outcome("security", ("iam", "permission", "policy"),
            "IAM policy grants excessive permissions or violates least privilege"),
    Outcome("security", ("logging", "audit"), "Logging or auditing is not enabled for this resource"),
    Outcome("security", ("ssl", "tls", "https"), "Resource is not using secure transport (TLS/SSL)"),
    Outcome("security", (), "Security configuration does not meet best practices"),
    Outcome("cost", ("reserved", "savings"), "On-demand usage exceeds 30% of total compute hours"),
    Outcome("cost", ("rightsiz", "oversiz"),
            "Resource is consistently underutilized (CPU/memory below 40%)"),
    Outcome("cost", ("generation", "previous"),
            "Resource is using a previous generation instance type"),
    Outcome("cost", ("storage",), "Storage tier does not match access patterns"),
    Outcome("cost", (), "Resource cost could be optimized"),
    Outcome("performance", ("throttl",), "Resource is experiencing throttling events"),
    Outcome("performance", ("latency",), "Latency exceeds acceptable thresholds"),
    Outcome("performance", ("capacity",), "Resource is approaching capacity limits"),
    Outcome("performance", ("cache",), "Cache hit ratio is below optimal threshold"),
    Outcome("performance", (), "Performance metrics indicate optimization opportunity"),
    Outcome("reliability", ("backup",), "Automated backups are not configured"),
    Outcome("reliability", ("replica", "multi-az"),
            "High availability configuration is not enabled"),
    Outcome("reliability", ("failover",), "Failover mechanism is not properly configured"),
    Outcome("reliability", (), "Reliability configuration does not meet best practices"),
    Outcome("any", ("tag",), "Resource is missing required tags"),
    Outcome("any", ("monitor",), "Monitoring is not properly configured"),
    Outcome("any", ("alarm",), "CloudWatch alarms are not configured"),
    Outcome("any", ("config", "setting"), "Configuration does not follow recommended settings"),
)

# Alert criteria, compact table.
ALERT_OUTCOMES_COMPACT = (
    Outcome("idle", (), "Resource has been idle or unused for an extended period"),
    Outcome("security", ("encrypt",), "Resource is not encrypted or uses outdated encryption"),
    Outcome("security", ("public",), "Resource is publicly accessible when it should not be"),
    Outcome("security", ("iam", "permission"),
            "IAM policy grants excessive permissions or violates least privilege"),
    Outcome("security", ("logging",), "Logging or auditing is not enabled for this resource"),
    Outcome("security", (), "Security configuration does not meet best practices"),
    Outcome("cost", ("rightsiz", "oversiz"),
            "Resource is consistently underutilized (CPU/memory below 40%)"),
    Outcome("cost", (), "Resource cost could be optimized"),
    Outcome("performance", (), "Performance metrics indicate optimization opportunity"),
    Outcome("reliability", ("backup",), "Automated backups are not configured"),
    Outcome("reliability", (), "Reliability configuration does not meet best practices"),
)

# Recommended action, full table.
ACTION_OUTCOMES = (
    Outcome("idle", (),
            "Review resource usage and delete if no longer needed, or investigate why it's idle"),
    Outcome("security", ("encrypt",), "Enable encryption using AWS KMS or service-managed keys"),
    Outcome("security", ("public",), "Restrict public access and implement proper access controls"),
    Outcome("security", ("password", "credential"),
            "Implement credential rotation policy and enable automatic rotation"),
    Outcome("security", ("iam", "permission"),
            "Review and restrict IAM permissions following least privilege principle"),
    Outcome("security", ("logging",), "Enable logging and configure log retention policies"),
    Outcome("security", (), "Review and update security configuration to meet best practices"),
    Outcome("cost", ("reserved", "savings"),
            "Analyze usage patterns and purchase Reserved Instances or Savings Plans"),
    Outcome("cost", ("rightsiz", "oversiz"),
            "Right-size the resource based on actual utilization metrics"),
    Outcome("cost", ("generation",),
            "Migrate to current generation instance type for better price-performance"),
    Outcome("cost", ("storage",), "Review storage tier and implement lifecycle policies"),
    Outcome("cost", (), "Review resource configuration for cost optimization opportunities"),
    Outcome("performance", ("throttl",),
            "Increase provisioned capacity or implement request queuing"),
    Outcome("performance", ("cache",),
            "Review cache configuration and implement caching strategy"),
    Outcome("performance", (), "Optimize resource configuration for improved performance"),
    Outcome("reliability", ("backup",), "Enable automated backups and configure retention period"),
    Outcome("reliability", ("replica", "multi-az"),
            "Enable Multi-AZ deployment or read replicas for high availability"),
    Outcome("reliability", (), "Implement redundancy and failover mechanisms"),
    Outcome("any", ("tag",), "Apply required tags following organizational tagging strategy"),
    Outcome("any", ("monitor",), "Configure CloudWatch monitoring and create dashboards"),
)

# Recommended action, compact table.
ACTION_OUTCOMES_COMPACT = (
    Outcome("idle", (),
            "Review resource usage and delete if no longer needed, or investigate why it's idle"),
    Outcome("security", ("encrypt",), "Enable encryption using AWS KMS or service-managed keys"),
    Outcome("security", ("public",), "Restrict public access and implement proper access controls"),
    Outcome("security", (), "Review and update security configuration to meet best practices"),
    Outcome("cost", (), "Review resource configuration for cost optimization opportunities"),
    Outcome("performance", (), "Optimize resource configuration for improved performance"),
    Outcome("reliability", (), "Implement redundancy and failover mechanisms"),
)

# Texts used when no outcome applies.
ALERT_PREFIX = "Condition detected: "
ALERT_PREFIX_CHARS = 100
DEFAULT_ACTION = "Review and update configuration following AWS best practices"
