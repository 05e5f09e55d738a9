"""Code values found in the source systems."""

# Status, scene, case and product codes of the policy and claim systems.
VALID_STATUS = ("0", "1", "7", "9", "10")
IN_FORCE_STATUS = ("0", "1")
ENDORSED_STATUS = ("4", "5")
REMOVED = "2"
YES = "是"
DEATH = "死亡"
DISABILITY = "残疾"
NO_DISABILITY = "无"
AT_WORK = "工作期间"
OFF_WORK = ("非工作期间", "上下班")
REJECTED = "拒赔"
WITHDRAWN = "撤案"
DIRECT = "直客"
EMPLOYER_GROUPS = ("外包雇主", "骑士保", "大货车")
CASUAL_GROUP = "零工保"
MUNICIPALITIES = ("北京市", "天津市", "上海市", "重庆市")
DIRTY_AMOUNTS = ("", ".", "#N/A")
CHINESE = "[\\u4e00-\\u9fa5]"
ID_CARD_15 = r"^[1-9]\d{7}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])\d{3}$"
ID_CARD_18 = r"^[1-9]\d{5}[1-9]\d{3}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])((\d{4})|\d{3}[A-Z])$"
MALE, FEMALE = "男", "女"
NIGHT_OWL, EARLY_RISER, COMMUTER = "夜猫子", "早起族", "上班族"
RIDE_EDITIONS = {"OFO00001": ("校园版", "30"), "OFO00002": ("城市版", "50")}
