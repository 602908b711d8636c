"""Mail domains from recorded lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import normalize_domain

# Mail exchangers by provider, the first match wins.
PROVIDERS = (
    (r"\.google\.com\z|googlemail\.com\z|\.l\.google\.com\z|smtp\.google\.com\z", "Google Workspace"),
    (r"mail\.protection\.outlook\.com\z|\.outlook\.com\z|olc\.protection\.outlook\.com\z", "Microsoft 365"),
    (r"pphosted\.com\z|ppe-hosted\.com\z", "Proofpoint"),
    (r"mimecast\.com\z|mimecast-offshore\.com\z|mimecast\.co\.za\z", "Mimecast"),
    (r"mx\.cloudflare\.net\z", "Cloudflare Email"),
    (r"zoho\.com\z|zohomail\.com\z|zoho\.eu\z|zoho\.in\z", "Zoho"),
    (r"messagingengine\.com\z|fastmail\.com\z", "Fastmail"),
    (r"iphmx\.com\z|cisco\.com\z", "Cisco/IronPort"),
    (r"barracuda(?:networks)?\.com\z|cudasvc\.com\z", "Barracuda"),
    (r"secureserver\.net\z", "GoDaddy"),
    (r"awsapps\.com\z|amazonaws\.com\z", "Amazon WorkMail/SES"),
    (r"protonmail\.ch\z|proton\.me\z|protonmail\.com\z", "Proton"),
    (r"yandex\.net\z|mx\.yandex", "Yandex"),
    (r"qq\.com\z|exmail\.qq\.com\z", "Tencent Exmail"),
    (r"aliyun\.com\z|mxhichina\.com\z", "Alibaba"),
    (r"messagelabs\.com\z", "Symantec MessageLabs"),
    (r"emailsrvr\.com\z", "Rackspace"),
    (r"forcepoint\.com\z|mailcontrol\.com\z", "Forcepoint"),
    (r"sophos\.com\z", "Sophos"),
    (r"trendmicro\.com\z|tmes\.trendmicro", "Trend Micro"),
)


def provider_of(host: Column) -> Column:
    bare, found = F.regexp_replace(F.lower(host), r"\.\z", ""), None
    for pattern, name in PROVIDERS:
        found = F.when(bare.rlike(pattern), name) if found is None else found.when(bare.rlike(pattern), name)
    return found


def classify_provider(hosts: Column) -> Column:
    """The provider of the first host, by priority, that has a known one."""
    return F.get(F.filter(F.transform(hosts, provider_of), lambda p: p.isNotNull()), F.lit(0))


def resolve_domains(targets: DataFrame, records: DataFrame, raw: str = "raw") -> DataFrame:
    """(raw, domain, email_domain, provider, has_mx, confidence, mx, signal) from recorded lookups.

    ``records`` (domain, priority, exchange, rcode): no record or a failed one is an error to try again,
    an answer without exchangers means that the domain takes no mail.
    """
    wanted = targets.select(F.col(raw).alias("raw"), normalize_domain(F.col(raw)).alias("domain"))
    hosts = F.sort_array(F.collect_set(F.when(F.col("exchange").isNotNull(), F.struct("priority", "exchange"))))
    known = records.groupBy("domain").agg(F.transform(hosts, lambda h: h["exchange"]).alias("mx"), F.bool_and(F.col("rcode").isin("NOERROR", "NXDOMAIN")).alias("answered"))
    joined = wanted.join(known, "domain", "left").withColumn("p", classify_provider(F.col("mx")))
    kind = (
        F.when(F.col("domain").isNull(), "invalid").when(~F.coalesce(F.col("answered"), F.lit(False)), "error")
        .when(F.size("mx") == 0, "none").when(F.col("p").isNotNull(), "high").otherwise("medium")
    )
    joined = joined.withColumn("confidence", kind)
    mail = F.col("confidence").isin("high", "medium")
    return joined.select(
        "raw", "domain", F.when(mail, F.col("domain")).alias("email_domain"), F.when(mail, F.coalesce("p", F.lit("other/self-hosted"))).alias("provider"),
        F.when(mail, True).when(F.col("confidence") == "none", False).alias("has_mx"), "confidence", F.when(mail, F.col("mx")).otherwise(F.array().cast("array<string>")).alias("mx"),
        F.when(F.col("confidence") == "invalid", "unparseable-domain").when(F.col("confidence") == "error", "lookup-failed").when(F.col("confidence") == "none", "no-mx")
        .when(F.col("confidence") == "high", F.concat(F.lit("provider-mx:"), "p")).otherwise("mx-present").alias("signal"))


def domain_report(targets: DataFrame, resolved: DataFrame) -> DataFrame:
    """(company, domain, email_domain, provider, confidence) of every target that was looked up, by company."""
    looked = resolved.where("domain is not null").select("domain", "email_domain", "provider", "confidence")
    return targets.select(F.col("key").alias("domain"), "company").join(looked, "domain").select("company", "domain", "email_domain", "provider", "confidence").orderBy(F.collate("company", "UNICODE"), "domain")


def predictable_counts(master: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row: domains without any address, how many of them take mail, and how many are dead."""
    held = F.coalesce(F.bool_or((F.coalesce("email", F.lit("")) != "") | (F.coalesce("business_email", F.lit("")) != "")), F.lit(False))
    bare = master.groupBy("domain").agg(held.alias("_held")).where(~F.col("_held")).select("domain")
    told = bare.join(resolved.where("domain is not null").select("domain", "confidence").distinct(), "domain", "left")
    return told.agg(F.count("*").alias("without_email"), F.count_if(F.col("confidence").isin("high", "medium")).alias("predictable"), F.count_if(F.col("confidence") == "none").alias("dead"))
