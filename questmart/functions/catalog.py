"""Names the series and the derived tables share."""

# The offers of the daily offer series, in series order.
SERIES_OFFERS = [
    "off_chest_legendary",
    "off_diamond_1500",
    "off_diamond_500",
    "off_hero_bundle_battlemage",
    "off_hero_bundle_deluxe_battlemage",
    "off_hero_bundle_deluxe_rogue",
    "off_hero_bundle_deluxe_warrior",
    "off_hero_bundle_rogue",
    "off_hero_bundle_warrior",
    "off_item_bundle_epic",
    "off_subscription_basic",
    "off_subscription_premium",
]
