"""Column names and types of every layer. Nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The landing files' column order.
RAW_COLUMNS: dict[str, str] = {
    "customer": "customer_id customer_name email primary_phone registered_at city area lat lng segment is_prime_member status",
    "restaurant": "restaurant_id restaurant_name cuisine_primary cuisine_secondary city area lat lng avg_rating"
    " commission_rate is_active onboarded_at",
    "delivery_agent": "agent_id agent_name phone hire_date city vehicle_type status",
    "menu_item": "menu_item_id restaurant_id item_name category price is_veg is_active",
    "promotion": "promo_id promo_code discount_percent start_date end_date max_discount_amt target_segment target_city",
    "order_header": "order_id customer_id restaurant_id order_created_at order_status payment_method promo_id order_subtotal"
    " order_discount delivery_fee total_amount expected_delivery_at actual_delivery_at cancellation_reason",
    "order_item": "order_id order_item_id menu_item_id qty item_price item_discount total_item_amount",
    "delivery_trip": "trip_id order_id agent_id pickup_time drop_time distance_km estimated_time_min actual_time_min"
    " sla_breach_flag",
    "payment": "payment_id order_id payment_status payment_at payment_amount",
    "customer_feedback": "feedback_id order_id customer_id rating comment sentiment_score created_at",
}

EVENTS = "customer_events"


def raw_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in RAW_COLUMNS[table].split()])


# The columns of the maintained tables.
DIM_CUSTOMER = (
    "customer_sk bigint, customer_id bigint, customer_name string, email string, primary_phone string, city string,"
    " area string, segment string, is_prime_member boolean, status string, effective_from timestamp_ntz,"
    " effective_to timestamp_ntz, is_current boolean, record_source string"
)
DIM_RESTAURANT = (
    "restaurant_sk bigint, restaurant_id bigint, restaurant_name string, cuisine_primary string, cuisine_secondary string,"
    " city string, area string, avg_rating double, commission_rate double, is_active boolean, onboarded_at timestamp_ntz,"
    " effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, record_source string"
)
DIM_RESTAURANT_SCD3 = (
    "restaurant_id bigint, restaurant_name string, current_cuisine string, previous_cuisine string,"
    " last_change_date timestamp_ntz, city string, area string"
)
DIM_DELIVERY_AGENT = (
    "agent_id bigint, agent_name string, phone string, hire_date timestamp_ntz, city string, vehicle_type string, status string"
)
DIM_PROMOTION = (
    "promo_id bigint, promo_code string, discount_percent decimal(5,2), start_date timestamp_ntz, end_date timestamp_ntz,"
    " max_discount_amt decimal(10,2), target_segment string, target_city string"
)
ROLE_ACCESS = "role_name string, access_type string, city string, restaurant_id bigint"
RUN_LOG = "proc_name string, run_ts timestamp_ntz, status string, message string"

# The order row every mart reads.
ENRICHED_COLUMNS = (
    "order_id order_date_key full_date total_amount order_subtotal order_discount delivery_fee net_food_amount discount_pct"
    " sla_breached platform_commission restaurant_payout end_to_end_min order_status payment_method promo_id is_delivered"
    " is_cancelled customer_id customer_name customer_city customer_area customer_segment restaurant_id restaurant_name"
    " restaurant_city restaurant_area cuisine_primary commission_rate distance_km sla_breach_flag rating sentiment_score"
).split()
