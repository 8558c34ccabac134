"""pricewright: listing analytics and price models as Spark DataFrame jobs."""
