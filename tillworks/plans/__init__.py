"""The relations: staging tables, business tables, dashboard queries, data checks and the rebuild that ties them."""
