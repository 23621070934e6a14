"""ZIP packages for tests."""

import zipfile

BASE = {
    "feed_info": "feed_start_date,feed_end_date\n{start},{end}\n",
    "agency": "agency_id\n1\n",
    "routes": "route_id,route_short_name,route_long_name,route_type\nL1,1,Line one,0\nL2,2,Line two,700\n",
    "routes_ext": "route_id,route_type_1\nL1,Nocna\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon\nS1,First,50.1,19.1\nS2,Second,abc,19.2\nS3,Third,50.3,19.3\n",
    "stops_ext": "stop_id,community_ids,city,stop_attribute_ids\nS1,7_8,Town,5\nS3,99,City,\n",
    "communities_ext": "community_id,community_name\n7,Seven\n",
    "stops_attributes_ext": "stop_type_id,stop_attr_name\n5,Terminus\n",
    "operators_ext": "operator_id,operator_name\nO1,Operator\n",
    "trips": "trip_id,route_id,direction_id,trip_headsign\nT1,L1,0,Centre\nT2,L2,1,Depot\n",
    "trips_ext": "trip_id,operator_id\nT1,O1\n",
    "stop_times": (
        "trip_id,stop_id,stop_sequence,arrival_time\n"
        "T1,S1,0,23:50:00\nT1,S2,1,24:05:00\nT2,S3,1,10:00:00\nT9,S1,1,10:00:00\n"
    ),
    "calendar": (
        "service_id,start_date,end_date,monday,tuesday,wednesday,thursday,friday,saturday,sunday\n"
        "1,{start},{end},1,1,1,1,1,1,1\n"
    ),
    "calendar_dates": "service_id,date,exception_type\n1,{start},2\n",
    "service_ext": "service_id,name\n1,Robocze\n",
}


def name_of(day: str, seq: int) -> str:
    return f"schedule_ZTM_{day}_{seq}_1.zip"


def write_package(folder, name, start, end, **members):
    """A package with the base members; a member given as None is left out."""
    folder.mkdir(parents=True, exist_ok=True)
    texts = {**BASE, **members}
    with zipfile.ZipFile(folder / name, "w") as archive:
        for member, text in texts.items():
            if text is not None:
                data = text.format(start=start, end=end) if isinstance(text, str) else text
                archive.writestr(f"{member}.txt", data)


def catalogue_of(spark, *names):
    return spark.createDataFrame([(n, f"https://example.org/{n}") for n in names], "name string, url string")
