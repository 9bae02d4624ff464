"""Fixed values the oracles state for themselves: columns, keys and fields of the marts.

They are written down here a second time on purpose.  An oracle that took them from the library could not
notice a wrong key there.
"""

# Fixed values, in the order of the marts.
ABSENT = (
    "product_name_displayname_15",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
)
EVENT_TEXTS = {
    "product_name_hostname_15": "link_domain",
    "competition_16": "competition",
    "page_name_17": "page_path",
    "page_name_18": "page_title",
    "screen_name_19": "screen_name",
    "article_master_id_27": "article_master_id",
    "article_child_id_27": "article_child_id",
    "page_type_28": "page_type",
    "event_category": "event_category",
    "event_action": "event_action",
    "Match_ID": "match_id",
    "Match_Name": "match_name",
    "event_label_57": "event_label",
    "videoType_58": "video_type",
    "Team_ID_63": "team_id",
    "video_id_68": "video_id",
    "article_master_name_69": "article_master_title",
    "articleChildName_69": "article_child_title",
    "video_name_70": "video_title",
    "exclusive_promo_id_75": "partners",
}
SECTION_TEXTS = {
    "content_section_1_85": "content_section_1",
    "content_section_2_86": "content_section_2",
}
USER_TEXTS = {
    "user_news_letter_71": "newsletter_subscriber",
    "user_team_72": "user_team",
}
ITEM_TEXTS = {
    "promoId": ("promotion_id", "promotion_id"),
    "promoName": ("promotion_name", "promotion_name"),
    "products_name_75": ("item_name", "item_name"),
    "products_list_name_76": ("item_list_name", "item_name"),
    "products_category_77": ("item_category", "item_name"),
}
HITS_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "product_id_14",
    "product_name_displayname_15",
    "product_name_hostname_15",
    "competition_16",
    "page_name_17",
    "page_name_18",
    "screen_name_19",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
    "language_26",
    "article_master_id_27",
    "article_child_id_27",
    "page_type_28",
    "event_category",
    "event_action",
    "TV_Platforms_55",
    "Match_ID",
    "Match_Name",
    "event_label_57",
    "videoType_58",
    "hit_type_59",
    "Team_ID_63",
    "video_id_68",
    "article_master_name_69",
    "articleChildName_69",
    "video_name_70",
    "user_news_letter_71",
    "user_team_72",
    "video_length_73",
    "player_id_74",
    "exclusive_promo_id_75",
    "promoId",
    "promoName",
    "products_name_75",
    "products_list_name_76",
    "products_category_77",
    "content_section_1_85",
    "content_section_2_86",
    "hitNumber",
    "promoIsView",
    "promoIsClick",
    "hit_isInteraction_62",
    "hit_time_60",
    "hit_isExit_61",
    "datedate",
)
ONLY_IN_FULL = (
    "content_section_1_85",
    "content_section_2_86",
    "datedate",
)
TARGET_LAYOUT = (
    "visitId",
    "fullVisitorId",
    "datedate",
    "hitNumber",
    "product_id_14",
    "product_name_displayname_15",
    "product_name_hostname_15",
    "competition_16",
    "page_name_17",
    "page_name_18",
    "screen_name_19",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
    "language_26",
    "article_master_id_27",
    "article_child_id_27",
    "page_type_28",
    "event_category",
    "event_action",
    "TV_Platforms_55",
    "Match_ID",
    "Match_Name",
    "event_label_57",
    "videoType_58",
    "hit_type_59",
    "hit_time_60",
    "hit_isExit_61",
    "hit_isInteraction_62",
    "Team_ID_63",
    "video_id_68",
    "article_master_name_69",
    "articleChildName_69",
    "video_name_70",
    "user_news_letter_71",
    "user_team_72",
    "video_length_73",
    "player_id_74",
    "exclusive_promo_id_75",
    "promoId",
    "promoName",
    "promoIsView",
    "promoIsClick",
    "products_name_75",
    "products_list_name_76",
    "products_category_77",
    "content_section_1_85",
    "content_section_2_86",
)
ATTRIBUTED_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "City_ID_64",
    "Gigya_Id_88",
    "engagement_time",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "Campaign_56",
    "Traffic_Source_62",
    "Custom_Acq_Channel_Name",
    "country_name_30",
    "country_code_uefa_30",
    "City_Name_65",
    "device_category_24",
    "Device_Language_87",
    "operatingSystemVersion",
    "newVisits",
    "pageviews_44",
    "screenviews_44",
    "total_visit_51",
    "is_login",
    "hits",
    "nbr_loggedin_user_46",
    "timeonesite",
    "timeOnScreen",
    "channel_name_13",
)
BASIC_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "channel_name_13",
    "device_category_24",
    "country_name_30",
    "country_code_uefa_30",
    "Custom_Acq_Channel_Name",
    "Campaign_56",
    "Traffic_Source_62",
    "City_Name_65",
    "City_ID_64",
    "hits",
    "newVisits",
    "pageviews_44",
    "screenviews_44",
    "nbr_loggedin_user_46",
    "total_visit_51",
    "timeonesite",
    "timeOnScreen",
)
PROMOTION_LAYOUT = (
    "visitId",
    "fullVisitorId",
    "date_5",
    "promoIsView",
    "promoIsClick",
    "promoId",
    "promoName",
    "hitNumber",
)
UA_HIT_FIELDS = {
    "hitNumber": "hitNumber",
    "product_id_14": "sourcePropertyInfo.sourcePropertyTrackingId",
    "product_name_displayname_15": "sourcePropertyInfo.sourcePropertyDisplayName",
    "product_name_hostname_15": "page.hostname",
    "page_name_18": "page.pageTitle",
    "screen_name_19": "appInfo.screenName",
    "event_category": "eventInfo.eventCategory",
    "event_action": "eventInfo.eventAction",
    "event_label_57": "eventInfo.eventLabel",
    "hit_type_59": "type",
    "hit_time_60": "time",
    "hit_isExit_61": "isExit",
    "hit_isInteraction_62": "isInteraction",
    "promoIsView": "promotionActionInfo.promoIsView",
    "promoIsClick": "promotionActionInfo.promoIsClick",
}
UA_REPEATED_FIELDS = {
    "Source_Property_Tracking_ID_20": "product_id_14",
    "hostname_21": "product_name_hostname_15",
    "Source_Property_Display_Name_22": "product_name_displayname_15",
}
UA_HIT_DIMENSIONS = {
    "language_26": 1,
    "page_type_28": 4,
    "competition_16": 10,
    "page_name_17": 14,
    "user_news_letter_71": 25,
    "user_team_72": 30,
    "video_name_70": 35,
    "video_id_68": 36,
    "video_length_73": 37,
    "article_master_id_27": 39,
    "article_master_name_69": 40,
    "article_child_id_27": 41,
    "articleChildName_69": 42,
    "Match_ID": 43,
    "Match_Name": 44,
    "player_id_74": 51,
    "Team_ID_63": 53,
    "exclusive_promo_id_75": 56,
    "videoType_58": 105,
    "TV_Platforms_55": 106,
}
UA_HIT_LISTS = {
    "promoId": ("promotion", "promoId", "promoId"),
    "promoName": ("promotion", "promoName", "promoId"),
    "products_name_75": ("product", "v2ProductName", "v2ProductName"),
    "products_list_name_76": ("product", "productListName", "v2ProductName"),
    "products_category_77": ("product", "v2ProductCategory", "v2ProductName"),
}
UA_SESSION_FIELDS = {
    "fullVisitorId": "fullVisitorId",
    "visitId": "visitId",
    "date_5": "date",
    "acq_channel_id_12": "trafficSource.campaignCode",
    "channel_name_13": "channelGrouping",
    "device_category_24": "device.deviceCategory",
    "country_name_30": "geoNetwork.country",
    "pageviews_44": "totals.pageviews",
    "screenviews_44": "totals.screenviews",
    "total_visit_51": "totals.visits",
    "timeonesite": "totals.timeOnSite",
    "hits": "totals.hits",
    "newVisits": "totals.newVisits",
    "timeOnScreen": "totals.timeOnScreen",
    "Custom_Acq_Channel_Name": "trafficSource.medium",
    "Campaign_56": "trafficSource.campaign",
    "Traffic_Source_62": "trafficSource.source",
    "City_ID_64": "geoNetwork.cityId",
    "City_Name_65": "geoNetwork.city",
}
UA_SESSION_DIMENSIONS = {
    "country_code_uefa_30": 2,
    "platform_id_10": 23,
    "nbr_loggedin_user_46": 24,
}
UA_HIT_LAYOUT = (
    "visitId",
    "fullVisitorId",
    "hitNumber",
    "product_id_14",
    "product_name_displayname_15",
    "product_name_hostname_15",
    "competition_16",
    "page_name_17",
    "page_name_18",
    "screen_name_19",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
    "language_26",
    "article_master_id_27",
    "article_child_id_27",
    "page_type_28",
    "event_category",
    "event_action",
    "TV_Platforms_55",
    "Match_ID",
    "Match_Name",
    "event_label_57",
    "videoType_58",
    "hit_type_59",
    "hit_time_60",
    "hit_isExit_61",
    "hit_isInteraction_62",
    "Team_ID_63",
    "video_id_68",
    "article_master_name_69",
    "articleChildName_69",
    "video_name_70",
    "user_news_letter_71",
    "user_team_72",
    "video_length_73",
    "player_id_74",
    "exclusive_promo_id_75",
    "promoId",
    "promoName",
    "promoIsView",
    "promoIsClick",
    "products_name_75",
    "products_list_name_76",
    "products_category_77",
)
UA_VISIT_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "channel_name_13",
    "device_category_24",
    "country_name_30",
    "country_code_uefa_30",
    "pageviews_44",
    "screenviews_44",
    "nbr_loggedin_user_46",
    "total_visit_51",
    "timeonesite",
    "hits",
    "newVisits",
    "timeOnScreen",
    "Custom_Acq_Channel_Name",
    "Campaign_56",
    "Traffic_Source_62",
    "City_ID_64",
    "City_Name_65",
)
