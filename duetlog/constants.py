"""Fixed values.

FIXED VALUES — these must equal the studied jobs' literals for results to
match (labels, sentinels, message templates).  They are data, kept together
here in natural order; every function takes them as overridable parameters.
"""

# --- sentinels -----------------------------------------------------------
UNKNOWN_REGION = "0"          # region field meaning "unknown"
NEITHER_USER_TYPE = "0"       # user type that is neither new nor old
MISSING_TEXT = "NULL"         # text null in delimited exports
MISSING_ERR = "unkonw"        # default for a missing err_code / err_msg (sic)
MALFORMED_LOG = ("0", "0", "0")

# --- defaults of the studied jobs -----------------------------------------
REFERENCE_AS_OF = "2021-04-15"   # fixed "today" of the profile jobs
NEW_USER_DAYS = 365
ACTIVE_DAYS = 365
LOVE_DAYS_SPLIT = 30
LOVE_DAYS_MAX = 1095
ALARM_THRESHOLD = 5
TOP_K = 20
UV_THRESHOLD = 1000

# --- user-type labels -------------------------------------------------------
USER_NEW = "new"
USER_OLD = "old"
LOVE_SHORT = "30days-"
LOVE_LONG = "30days+"

# --- country pair labels: home country + partner -> label -------------------
HOME_COUNTRY = "中国"
COUNTRY_PAIR_LABELS = {
    "澳大利亚": "中澳",
    "美国": "中美",
    "新西兰": "中新",
    "加拿大": "中加",
    "英国": "中英",
}
OTHER_PAIR = "other"
SAME_COUNTRY = "同国"
DIFFERENT_COUNTRY = "异国"

# --- service labels for alarm messages ---------------------------------------
SERVICE_LABELS = {
    "farm": "农场",
    "tree": "爱情树",
    "lovespace": "情侣空间",
    "house": "小家",
    "pet": "情侣宝宝",
    "love_pet": "情侣宝宝",
}

# --- event routing labels -------------------------------------------------------
ROUTE_LOGIN = "登录"
ROUTE_SUNSHINE = "晒太阳"
ROUTE_WATER = "浇水"

# --- alarm message templates (status 0 new, 1 ongoing, 2 recovered) ------------
# Placeholders: service, bn, url, err_code, err_msg, num, time, total, final_time.
ALARM_TEMPLATE_NEW = (
    "\n### 项目：<font color=\"warning\">{service}</font>接口报警，请相关同学注意。\n\n"
    ">接口分类：<font color=\"comment\">{bn}</font>\n"
    ">接口URL：<font color=\"warning\">{url}</font>\n"
    ">错误代码：<font color=\"comment\">{err_code}</font>\n"
    ">错误信息：<font color=\"comment\">{err_msg}</font>\n"
    ">当前报错次数：<font color=\"warning\">{num}</font> <font color=\"comment\">(阈值100)</font> \n"
    ">告警时间：<font color=\"comment\">{time}</font> \n"
    ">备注：<font color=\"comment\">来自埋点报警服务</font>\n"
)
ALARM_TEMPLATE_ONGOING = (
    "\n### 项目：<font color=\"warning\">{service}</font>接口持续报警，请相关同学注意。\n\n"
    ">接口分类：<font color=\"comment\">{bn}</font>\n"
    ">接口URL：<font color=\"warning\">{url}</font>\n"
    ">错误代码：<font color=\"comment\">{err_code}</font>\n"
    ">错误信息：<font color=\"comment\">{err_msg}</font>\n"
    ">当前报错次数：<font color=\"warning\">{num}</font> <font color=\"comment\">(阈值100)</font> \n"
    ">告警时间：<font color=\"comment\">{time}</font> \n"
    ">备注：<font color=\"warning\">持续告警中</font>\n"
)
ALARM_TEMPLATE_RECOVERED = (
    "\n### 项目：<font color=\"info\">{service}</font>接口报警已恢复。\n\n"
    ">接口分类：<font color=\"comment\">{bn}</font>\n"
    ">接口URL：<font color=\"info\">{url}</font>\n"
    ">错误代码：<font color=\"comment\">{err_code}</font>\n"
    ">错误信息：<font color=\"comment\">{err_msg}</font>\n"
    ">当前报错次数：<font color=\"info\">{num}</font> <font color=\"comment\">(阈值100)</font>\n"
    ">总报错次数：<font color=\"info\">{total}</font>\n"
    ">告警时间：<font color=\"comment\">{time}</font> \n"
    ">恢复时间：<font color=\"comment\">{final_time}</font>\n"
    ">备注：<font color=\"info\">告警恢复</font>\n"
)
ALARM_UNKNOWN_STATE = "未知状态"

# --- report column titles (presentation only) -------------------------------------
COHORT_TITLES = {
    "love_days": "恋爱天数",
    "retention_rate": "留存率",
    "pay_rate": "付费率",
    "arpu": "人均付费(ARPU)",
    "median_paid_cost": "付费中位数",
    "arppu": "付费均值(ARPPU)",
    "std_paid_cost": "标准差",
    "space_cnt": "样本数量(包含付费为0)",
}

# --- columns and schemas of the studied inputs, in file order -------------------
PROFILE_COLUMNS = ("space_id", "a_gender", "b_gender", "a_birthday", "b_birthday", "a_retention",
                   "b_retention", "last_use_time", "a_regist_time", "b_regist_time", "registe_space_dt",
                   "anniversary_day", "close_time", "total_cost", "a_ip", "b_ip")
IP_RANGE_COLUMNS = ("start_ip", "end_ip", "country", "area", "province", "city", "isp")
GUIDE_COLUMNS = ("date", "dim", "el", "num")
ERROR_LOG_SCHEMA = ("sv STRING, bn STRING, url STRING, err_code STRING, err_msg STRING, "
                    "`@timestamp-log` BIGINT, ip_addr STRING")
EVENT_ROUTE_SCHEMA = "sv STRING, bn STRING, el STRING, time STRING"

# --- words that mark request-log lines ------------------------------------------
VIEW_MARKER = "Microscopic_view"      # lines that hold it are dropped from the address counts
LOG_MARKER = "Micro"                  # lines of the visitor counts hold it
