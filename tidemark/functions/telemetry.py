"""Column functions of the telemetry records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and upper bounds of the signal scales.
RSSI_BOUNDS = ((-85, "bad"), (-80, "low"), (-70, "medium"), (-60, "good"))
SNR_BOUNDS = ((10, "bad"), (15, "low"), (25, "medium"), (39, "good"))
SIGNAL_TOP = "excelent"
SIGNAL_NONE = "unknown"

# Hosts and address parts of the social and media rules.
MEDIA_SUFFIX = r"\.(jpg|gif|png|mp4|avi|mp3)"
PROFILE_URL = "http://www.facebook.com/profile.php?id="
TWITTER_URL = "http://www.twitter.com/"
YOUTUBE_URL = "https://www.youtube.com/user/"


def _scale(value: Column, bounds) -> Column:
    out = None
    for top, name in bounds:
        out = F.when(value <= top, name) if out is None else out.when(value <= top, name)
    return out.otherwise(SIGNAL_TOP)


def rssi_class(rssi: Column) -> Column:
    return F.when(rssi.isNull() | (rssi == 0), SIGNAL_NONE).otherwise(_scale(rssi, RSSI_BOUNDS))


def snr_class(snr: Column) -> Column:
    return F.when(snr.isNull(), SIGNAL_NONE).otherwise(_scale(snr, SNR_BOUNDS))


def signal_quality(rssi: Column, snr: Column) -> Column:
    """Percent from the clamped signal levels; null when either is missing or snr is 0."""
    strength = (F.least(F.greatest(rssi, F.lit(-85)), F.lit(-50)) + 85) / F.lit(35.0)
    clarity = (F.least(F.greatest(snr, F.lit(10)), F.lit(40)) - 10) / F.lit(30.0)
    percent = F.floor((strength + clarity) / F.lit(2.0) * 100 + 0.5) / F.lit(100.0) * F.lit(100.0)
    usable = rssi.isNotNull() & snr.isNotNull() & (snr != 0)
    return F.when(usable, percent.cast("int"))


def text_hash(text: Column) -> Column:
    """32-bit polynomial hash (base 31) of an ASCII text, as a signed INT."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    total = F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, c: F.pmod(acc * 31 + c, F.lit(1 << 32)))
    return F.when(total >= (1 << 31), total - (1 << 32)).otherwise(total).cast("int")


def with_default_time(timestamp: Column, now: Column) -> Column:
    """The record's own time, else ``now`` (epoch seconds)."""
    return F.coalesce(timestamp, now)


def _after(url: Column, mark: str, stops: str, *, to_end: bool = False) -> Column:
    """Text after ``mark`` up to the first stop character; null when there is none."""
    pattern = rf"\Q{mark}\E([^{stops}]*)" + ("" if to_end else rf"[{stops}]")
    found = F.regexp_extract(url, f"^.*?{pattern}", 1)
    return F.when(url.rlike(f"^.*?{pattern}"), found)


def _plain(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("%3A"), F.lit(":")), F.lit("%2F"), F.lit("/"))


def url_fields(host: Column, url: Column) -> dict[str, Column]:
    """Social and media fields of an HTTP flow. The first host rule that fits decides."""
    hosts = (
        ("dropbox", host.contains("dropbox.com")),
        ("facebook", host.contains("www.facebook.com")),
        ("facebook_cdn", host.contains("akamaihd.net") | host.contains("ak.fbcdn.net")),
        ("maps", host.contains("maps.google.com")),
        ("linkedin", host.contains("www.linkedin.com")),
        ("twitter_api", host.contains("api.twitter.com")),
        ("twitter", host.contains("twitter.com")),
        ("youtube", host.contains("gdata.youtube.com")),
    )
    rule = None
    for name, fits in hosts:
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
    rule = rule.otherwise(F.when(host.isNotNull(), "media"))

    def when(name: str, value: Column) -> Column:
        return F.when(rule == name, value)

    dropbox_id = F.regexp_extract(url, r"user_id.([^?/&]*)[?/&]", 1)
    cdn_user = F.regexp_extract(url, r"^[^_]*_([^_]*)_", 1)
    liked = url.contains("plugins/like.php")
    shared = ~liked & url.contains("/plugins/share_button")
    youtube_name = F.regexp_extract(url, r"/feeds/api/users/([^?/]*)[?/]", 1)
    user = F.coalesce(
        when("dropbox", F.when(url.rlike(r"user_id.[^?/&]*[?/&]"), F.concat(F.lit("Dropbox id: "), dropbox_id))),
        when("facebook_cdn", F.when(url.rlike("^[^_]*_[^_]*_"), F.concat(F.lit(PROFILE_URL), cdn_user))),
        when("twitter_api", F.concat(F.lit(TWITTER_URL), _after(url, "screen_name=", "&"))),
        when("twitter", F.when(url.contains("status") & url.contains("/"),
                               F.concat(F.lit(TWITTER_URL), F.substring_index(url, "/", 1)))),
        when("youtube", F.when(url.rlike("/feeds/api/users/[^?/]*[?/]"), F.concat(F.lit(YOUTUBE_URL), youtube_name))),
    )
    tail = F.when(F.length(url) > 5, F.substring(url, -5, 5)).otherwise("")
    return {
        "http_social_user": user,
        "facebook_like": when("facebook", F.when(liked, _plain(_after(url, "href=", "&")))),
        "facebook_share": when("facebook", F.when(shared, _plain(_after(url, "href=", "&")))),
        "google_maps_location": when(
            "maps",
            F.when(url.contains("/maps/api/staticmap?"),
                   F.replace(_after(url, "center=", "&"), F.lit(","), F.lit("%2C"))),
        ),
        "linkedin_share": when("linkedin", _plain(_after(url, "share?url=", "&", to_end=True))),
        "http_social_media": when(
            "media", F.when(tail.rlike(MEDIA_SUFFIX), F.concat(F.lit("http://"), host, url))
        ),
    }
