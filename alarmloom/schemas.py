"""Column lists and declared schemas of the input documents and the output tables."""

from pyspark.sql import types as T

# --- Fixed values: names that must match the documents and tables exactly -----------------------

HEADER_KEYS = """
messageProtocolVersion messageDeviceTypeId messageProductId messageDeviceDescribe
messageEmbeddedSoftwareVersion messageChipVersion messageDeviceSerialId messagePackageId
messageLoadLength messageNumber messageSplitSerialId verifyCode reserved
""".split()

TRAILER_KEYS = ["tempVerifyCode", "messageSplit"]

ALARM_LIST_KEY = "basicMessageBasicList"
MODULE_KEY = "verifyFunctionModuleCode"
TYPE_KEY = "verifyTypeId"
DESCRIPTION_KEY = "incidentdescription"
DISPOSE_KEY = "disposetime"

# Keys seen inside one nested alarm. A record carries some of them; any other key goes to `extras`.
BODY_KEYS = """
srcMac destMac srcIp destIp srcPort destPort protocolType byteNumber packageNumber loadLength
verifyMessageBodyType verifyTypeId verifyFunctionModuleCode messageBodyLength messageBodyId
messageBodyType typeId functionModuleCode sendSourceModuleId timeStamp messageInputPhysicsPort
originalPackageVlan changePort changeIp currentState flowIndex policeIndex upByteNumber
downByteNumber upPackageNumber downPackageNumber vlan tagDescribe incidentdescription
""".split()

# The 13 fields of the declared nested table.
NESTED_ALARM_KEYS = """
srcMac destMac srcIp destIp srcPort destPort protocolType byteNumber packageNumber
verifyMessageBodyType verifyTypeId loadLength verifyFunctionModuleCode
""".split()

VENDOR_COLUMNS = """
date uuid sendType productVendorName deviceSendProductName deviceProductType deviceAssetSubType
customerId deviceId eventCount securityEyeLogType productId companyId hostId groupId projectName
sendHostName deviceName sendHostAddress deviceAddress deviceMac machineCode hostType transProtocol
protocolType appProtocol sendLogId logSessionId srcAddress srcPort srcMacAddress destAddress
destPort destMacAddress vlanID srcGeoCountry srcGeoRegion srcGeoCity srcGeoUnit srcGeoAddress
srcGeoLatitude srcGeoLongitude srcGeoPoint destGeoCountry destGeoRegion destGeoCity destGeoUnit
destGeoAddress destGeoLatitude destGeoLongitude destGeoPoint srcSecurityZone destSecurityZone
direction severity name deviceCat catObject catBehavior catTechnique catOutcome catSignificance
eventId startTime endTime collectorReceiptTime deviceReceiptTime srcTransAddress ruleId ruleName
ruleType ruleLevel alarmMessage payload alarmDesc ruleLink fileName fileMd5 attackFileType
requestDomain responseCode attackStage attackDirection attackStatus pcapRecord requestMethod
requestUrlQuery requestHeader requestBody responseHeader responseMsg srcUserName passwd
destHostName IoC sclass IoCLevel confidence IoCType mclass fileType fileSize sha256 virusType
virusName sandboxReportId message alertType currenttime
""".split()

METADATA_COLUMNS = """
date uuid device_id device_ip interface_icon data_type time sip sipv6 smac sport dip dipv6 dmac
dport network_protocol transport_protocol session_protocol app_protocol sess_id log_type mail_time
from to cc subject bcc returnpath received send_server_domain send_server_ip content_encoding
content_length mail_size file_list client_total_byte client_total_pkt server_total_byte
server_total_pkt flow_start_time flow_end_time flow_duration total_byte avg_pkt_byte total_pkt
avg_pkt_num avg_pkt_size close_status avg_delay_time retrans_pkt_num version session_id
server_name issuer_name common_name not_before not_after public_key c_cipher_suite s_cipher_suite
ja3 ja3s method uri origin cookie agent referer http_req_header http_res_code content_type
content_length_tow http_res_heade dns_type host mx cname res_code_one count dns_query_type aa tc
rd ra rep_rr_info aa_rr_info append_rr_info rr_ttl dns_req_len dns_res_len dns_req_rr_type
dns_res_rr_type dns_res_ip version_two username dbname req_cmd res_code file_dir file_name
file_type file_size file_md5 currenttime
""".split()

BACKFILL_COLUMNS = """
id messageProtocolVersion messageDeviceTypeId messageProductId messageDeviceDescribe
messageEmbeddedSoftwareVersion messageChipVersion messageDeviceSerialId messagePackageId
messageLoadLength messageNumber messageSplitSerialId verifyCode reserved destMac srcIp destIp
srcPort destPort protocolType byteNumber packageNumber verifyMessageBodyType verifyTypeId
loadLength verifyFunctionModuleCode tempVerifyCode messageSplit srcMac vlan tagDescribe date uuid
event_level disposal disposal_instructions downPackageNumber upByteNumber changeIp changePort
upPackageNumber currentState downByteNumber size status messageBodyType messageBodyId
messageBodyLength sendSourceModuleId functionModuleCode messageInputPhysicsPort timeStamp typeId
messageSplitdestIp classification triggerStrategy strategyType pid
""".split()

WIFI_COLUMNS = """
uuid event_type time_sta time_date device_id ssid mac encryption terminal_ssid terminal_mac channel
primary_classification secondary_classification power distance monitoring_site index_name upside
down duration
""".split()

WIFI_KEYS = """
eventType time deviceId ssid mac encryption terminalSsid terminalMac channel primaryClassification
secondaryClassification power distance monitoringSite indexName upside down duration
""".split()

# --- Declared schemas ---------------------------------------------------------------------------


def _strings(names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Layout of a Kafka source; every parsing operator takes a frame with these columns.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

NESTED_REPORT_SCHEMA = T.StructType(
    _strings(HEADER_KEYS).fields
    + [T.StructField(ALARM_LIST_KEY, T.ArrayType(_strings(NESTED_ALARM_KEYS)))]
    + _strings(TRAILER_KEYS).fields
)

# The long fields arrive as numeric strings, so the documents are read as text and cast after.
APP_USAGE_TEXT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("data", T.ArrayType(_strings(["package", "activetime"]))),
    ]
)

WIFI_SCHEMA = _strings(WIFI_KEYS)
