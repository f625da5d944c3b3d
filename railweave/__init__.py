"""Railway timetable analytics on Spark: feeds in, harmonised stops, routes, trips and times out, and queries over them."""
