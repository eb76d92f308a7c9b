"""Declared schemas; nothing is inferred."""

METRICS = "struct<likes:bigint,retweets:bigint,replies:bigint,quotes:bigint>"
EMBEDDED = f"struct<id:string,authorId:string,handle:string,text:string,createdAt:string,metrics:{METRICS},source:string>"
POST = f"id string, authorId string, createdAt string, capturedAt string, type string, refId string, lang string, text string, metricsAtCapture {METRICS}, quoted {EMBEDDED}, reposted {EMBEDDED}"
METRIC_ROW = "post_id string, likes bigint, retweets bigint, replies bigint, quotes bigint, bookmarks bigint, impressions bigint, refreshedAt string, fromCapture boolean, pass72 boolean, unavailable boolean"
DAY_FILE = "assignments map<string,array<array<string>>>, incidents map<string,struct<kind:string,place:string,name:string>>, emerging array<struct<label:string,ids:array<string>>>, pendingIds array<string>, unclassified array<string>, corrected map<string,string>"
NEWS = "id string, sourceId string, publisher string, url string, title string, summary string, passages array<string>, publishedAt string, fetchedAt string, extract string, lang string, version bigint, hash string"
ROSTER = "handle string, member string, account_type string, caucuses string, state_district string, status string"
LEDGER = "day date, stage string, model string, batch boolean, calls bigint, input bigint, output bigint, cache_read bigint, cache_write bigint"
VERDICT = "item_id string, labels array<array<string>>, alternatives array<array<array<string>>>, confidence string, basis string, unreadable boolean, gap string"
FLOOR = "`_congress-num` string, `_week-date` string, category array<struct<_type:string,`floor-items`:struct<`floor-item`:array<struct<_id:string,`_add-date`:string,`_publish-date`:string,`_remove-date`:string,`legis-num`:string,`floor-text`:string,files:struct<file:array<struct<`_doc-url`:string,`_doc-type`:string>>>>>>>>"
STATUSES = ("house", "senate", "former", "org")
