import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Row  # noqa: E402

from pricewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    """Five listings of the shape model code meets."""
    rows = [
        (1, "acme", "New", "red", "menswear", "tops", "polos", "S", "shirt", "red cotton shirt", "style classic", 100),
        (3, "bolt", "Gently Used", "blue", "menswear", "bottoms", "denim", "28", "jacket", "blue denim jacket", "missing", 200),
        (2, "crow", "Used", "green", "womenswear", "dresses", "gowns", "XS", "shoes", "black leather shoes", "leather", 150),
        (4, "dune", "Worn", "black", "womenswear", "accessories", "belts", "L", "hat", "cowboy hat", "rodeo west", 300),
        (5, "ember", "New", "white", "womenswear", "footwear", "boots", "8", "necklace", "silver necklace", "jewel", 400),
    ]
    names = "n_photos designer condition color department category subcategory size item_name description hashtags sold_price"
    return spark.createDataFrame([Row(id=str(i), **dict(zip(names.split(), r))) for i, r in enumerate(rows)]).repartition(2)
