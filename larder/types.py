"""Columns and schemas of product rows."""

from __future__ import annotations

# Canonical column names.
BASE_COLUMNS = (
    "code created_t product_name quantity product_quantity serving_size serving_quantity brands categories labels "
    "emb_codes ingredients_text ingredients_tags nutriscore_grade nutriscore_score categories_tags labels_tags "
    "countries_tags no_nutrition_data"
).split()
NUTRIENTS = (
    "added-sugars alcohol alpha-linolenic-acid biotin caffeine calcium carbohydrates-total carbohydrates cholesterol "
    "choline chromium copper docosahexaenoic-acid eicosapentaenoic-acid energy-kcal energy-kj energy fat fiber fructose "
    "fruits-vegetables-legumes-estimate-from-ingredients fruits-vegetables-legumes "
    "fruits-vegetables-nuts-estimate-from-ingredients fruits-vegetables-nuts glucose glycemic-index iodine iron "
    "magnesium maltose manganese monounsaturated-fat nova-group nutrition-score-fr omega-3-fat omega-6-fat "
    "pantothenic-acid phosphorus polyols polyunsaturated-fat potassium proteins salt saturated-fat selenium sodium "
    "starch sucrose sugars taurine trans-fat vitamin-a vitamin-b12 vitamin-b1 vitamin-b2 vitamin-b6 vitamin-b9 "
    "vitamin-c vitamin-d vitamin-e vitamin-k vitamin-pp zinc"
).split()
TAG_COLUMNS = ["ingredients_tags", "categories_tags", "labels_tags", "countries_tags"]
NUMBER_COLUMNS = ["created_t", "product_quantity", "serving_quantity", "nutriscore_score"]
DOCUMENT_ONLY = ["_id", "_keywords", "id", "categories_hierarchy", "brands_hierarchy", "countries_hierarchy"]

NUTRIENT_COLUMNS = [f"{n}_100g" for n in NUTRIENTS]
COLUMNS = [*BASE_COLUMNS, *NUTRIENT_COLUMNS]

NUTRIENT_VALUE = "struct<value:double,unit:string,value_computed:double>"
INPUT_SET = f"struct<source:string,preparation:string,per:string,nutrients:map<string,{NUTRIENT_VALUE}>>"


def field_name(column: str) -> str:
    """``saturated-fat_100g`` to ``saturated_fat_100g``."""
    return column.replace("-", "_") if column.endswith("_100g") else column


def column_name(field: str) -> str:
    """The inverse of :func:`field_name`."""
    return field[:-5].replace("_", "-") + "_100g" if field.endswith("_100g") else field
