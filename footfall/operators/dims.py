"""Fixed lookup tables and the joins that use them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

# Device codes and their names.
DEVICE_MODELS = """
iPhone1,1|iPhone 1G
iPhone1,2|iPhone 3G
iPhone2,1|iPhone 3GS
iPhone3,1|iPhone 4
iPhone3,3|Verizon iPhone 4
iPhone4,1|iPhone 4S
iPhone5,1|iPhone 5 (GSM)
iPhone5,2|iPhone 5 (GSM+CDMA)
iPhone5,3|iPhone 5c (GSM)
iPhone5,4|iPhone 5c (Global)
iPhone6,1|iPhone 5s (GSM)
iPhone6,2|iPhone 5s (Global)
iPhone7,1|iPhone 6+
iPhone7,2|iPhone 6
iPhone8,1|iPhone 6s
iPhone8,2|iPhone 6s+
iPhone8,4|iPhone SE
iPhone9,1|iPhone 7
iPhone9,3|iPhone 7 (not support CDMA)
iPhone9,2|iPhone 7+
iPhone9,4|iPhone 7+ (not support CDMA)
iPhone10,1|iPhone 8
iPhone10,4|iPhone 8 (not support CDMA)
iPhone10,2|iPhone 8+
iPhone10,5|iPhone 8+ (not support CDMA)
iPhone10,3|iPhone X
iPhone10,6|iPhone X (not support CDMA)
iPod1,1|iPod Touch 1G
iPod2,1|iPod Touch 2G
iPod3,1|iPod Touch 3G
iPod4,1|iPod Touch 4G
iPod5,1|iPod Touch 5G
iPod7,1|iPod Touch 6G
iPad1,1|iPad
iPad2,1|iPad 2 (WiFi)
iPad2,2|iPad 2 (GSM)
iPad2,3|iPad 2 (CDMA)
iPad2,4|iPad 2 (WiFi)
iPad2,5|iPad Mini (WiFi)
iPad2,6|iPad Mini (GSM)
iPad2,7|iPad Mini (GSM+CDMA)
iPad3,1|iPad 3 (WiFi)
iPad3,2|iPad 3 (GSM+CDMA)
iPad3,3|iPad 3 (GSM)
iPad3,4|iPad 4 (WiFi)
iPad3,5|iPad 4 (GSM)
iPad3,6|iPad 4 (GSM+CDMA)
iPad4,1|iPad Air (WiFi)
iPad4,2|iPad Air (Cellular)
iPad4,3|iPad Air
iPad4,4|iPad Mini 2 (WiFi)
iPad4,5|iPad Mini 2 (Cellular)
iPad4,6|iPad Mini 2 (Rev)
iPad4,7|iPad Mini 3 (WiFi)
iPad4,8|iPad Mini 3 (WiFi)
iPad4,9|iPad Mini 3 (WiFi+Cellular)
iPad5,1|iPad Mini 4 (WiFi)
iPad5,2|iPad Mini 4 ((WiFi+Cellular)
iPad5,3|iPad Air 2 (WiFi)
iPad5,4|iPad Air 2 ((WiFi+Cellular)
iPad6,3|iPad Pro (9.7 inch WiFi)
iPad6,4|iPad Pro (9.7 inch WiFi+LTE)
iPad6,7|iPad Pro (12.9 inch WiFi)
iPad6,8|iPad Pro (12.9 inch WiFi+LTE)
iPad6,11|iPad (5th generation 9.7 inch WiFi)
iPad6,12|iPad (5th generation 9.7 inch WiFi+Cellular)
iPad7,1|iPad Pro (2nd generation 12.9 inch WiFi)
iPad7,2|iPad Pro (2nd generation 12.9 inch WiFi+Cellular)
iPad7,3|iPad Pro (10.5 inch WiFi)
iPad7,4|iPad Pro (10.5 inch WiFi+Cellular)
i386|Simulator
x86_64|Simulator
"""

# Radio technologies and their labels.
RADIO_LABELS = """
CTRadioAccessTechnologyGPRS|GPRS
CTRadioAccessTechnologyEdge|2.75G EDGE
CTRadioAccessTechnologyWCDMA|3G
CTRadioAccessTechnologyHSDPA|3.5G HSDPA
CTRadioAccessTechnologyHSUPA|3.5G HSUPA
CTRadioAccessTechnologyCDMA1x|2G
CTRadioAccessTechnologyCDMAEVDORev0|3G
CTRadioAccessTechnologyCDMAEVDORevA|3G
CTRadioAccessTechnologyCDMAEVDORevB|3G
CTRadioAccessTechnologyeHRPD|HRPD
CTRadioAccessTechnologyLTE|4G
"""


def pairs(listing: str) -> list[tuple[str, str]]:
    return [tuple(line.split("|")) for line in listing.strip().splitlines()]


def device_model(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pairs(DEVICE_MODELS), "code STRING, name STRING")


def network_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pairs(RADIO_LABELS), "radio STRING, label STRING")


def with_device_model(events: DataFrame, dim: DataFrame | None = None, code="deviceCode") -> DataFrame:
    """`uaDevice`: name of the device code; an unknown code stands for itself."""
    if dim is None:
        dim = F.broadcast(device_model(events.sparkSession))  # 72 rows, fixed
    named = dim.select(F.col("code").alias("__code"), F.col("name").alias("__name"))
    return (
        events.join(named, events[code] == named["__code"], "left")
        .withColumn("uaDevice", F.coalesce("__name", code))
        .drop("__code", "__name")
    )


def with_network_type(
    events: DataFrame, dim: DataFrame | None = None, reach="reachability", radio="radio"
) -> DataFrame:
    """`netType` from reachability (`none`, `wifi`, `wwan`) and radio technology;
    an unknown radio gives empty text."""
    if dim is None:
        dim = F.broadcast(network_type(events.sparkSession))  # 11 rows, fixed
    named = dim.select(F.col("radio").alias("__radio"), F.col("label").alias("__label"))
    label = (
        F.when(F.col(reach) == "none", "no network")
        .when(F.col(reach) == "wifi", "Wifi")
        .when(F.col(reach) == "wwan", F.coalesce("__label", F.lit("")))
        .otherwise("")
    )
    return (
        events.join(named, events[radio] == named["__radio"], "left")
        .withColumn("netType", label)
        .drop("__radio", "__label")
    )
