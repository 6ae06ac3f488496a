"""Small hand-made seed files holding the edge cases of every mart."""

SEED_FILES = {
    "business_customer": [
        "c1,Alpen AG,AG,Weg 1,04069,Basel,BS,CH,Ann,a@alpen.example,+41 1,TRUE,2024-01-01",
        "c2,Berg GmbH,GmbH,Weg 2,8000,Zürich,ZH,CH,Bob,b@berg.example,+41 2,FALSE,2024-02-01",
        'c3,"Tal, Söhne",AG,Weg 3,3000,Bern,BE,CH,Cid,c@tal.example,+41 3,TRUE,2024-03-01',
    ],
    "customer_contact": [
        "k1,c1,Ann,A,BUYER,ann@alpen.example,+41 11,TRUE",
        "k2,c1,Abe,B,OWNER,abe@alpen.example,+41 12,TRUE",
        "k3,c2,Bob,C,BUYER,bob@berg.example,+41 13,FALSE",
        "k4,c3,Cid,D,BUYER,cid@tal.example,+41 14,TRUE",
    ],
    "vehicle": [
        "v1,ZH 1,TRUCK,Make,M1,2020,1000,10.5,DIESEL,Basel,TRUE,2025-01-01",
        "v2,ZH 2,VAN,Make,M2,2021,500,5.5,ELECTRIC,Bern,TRUE,2025-02-01",
        "v3,ZH 3,VAN,Make,M2,2021,500,5.5,ELECTRIC,Bern,FALSE,2025-02-01",
    ],
    "gps_position": [
        "p1,v1,2026-01-01 10:00:00,47.1,8.1,50.0,90.0,TRUE",
        "p2,v1,2026-01-01 11:00:00,47.2,8.2,60.0,91.0,FALSE",
        "p3,v2,2026-01-01 12:00:00,47.3,8.3,70.0,92.0,TRUE",
        "p4,v2,,47.4,8.4,80.0,93.0,TRUE",
    ],
    "warehouse": [
        "w1,Nord,Weg 1,4000,Basel,BS,47.5,7.5,500,TRUE",
        "w2,Ost,Weg 2,8000,Zürich,ZH,47.3,8.5,700,TRUE",
    ],
    "warehouse_zone": [
        "z1,w1,Z1,STORAGE,100,FALSE",
        "z2,w1,Z2,COLD,50,TRUE",
        "z3,w1,Z3,COLD,30,TRUE",
    ],
    "order_header": [
        "o1,c1,2026-01-01,DELIVERED,Weg 1,4000,Basel,100.00,CHF,Basel",
        "o2,c1,2026-01-03,PENDING,Weg 2,8000,Zürich,40.50,CHF,Bern",
        "o3,c2,2026-01-02,SHIPPED,Weg 3,3000,Bern,60.00,CHF,Basel",
    ],
    "order_line_item": [
        "l1,o1,p1,2,10.00,20.00",
        "l2,o1,p2,1,30.00,30.00",
        "l3,o1,p1,3,10.00,30.00",
        "l4,o3,p2,1,30.00,30.00",
    ],
    "product": [
        "p1,Skis,SPORT,04069061,4.50,9.99,CHF,CH,FALSE,TRUE,2024-01-01",
        "p2,Acid,CHEM,28061000,1.00,100.00,CHF,DE,TRUE,TRUE,2024-01-02",
        "p3,Tea,FOOD,09021000,0.20,5.00,CHF,CN,FALSE,FALSE,2024-01-03",
    ],
    "product_tariff": [
        "t1,p1,04069061,Sport goods,5.00,7.70,0.00",
        "t2,p2,28061000,Acids,2.50,7.70,1.00",
        "t3,p2,28062000,Acids special,3.50,7.70,1.00",
    ],
    "shipment": [
        "s1,o1,v1,Basel,Bern,3000,DELIVERED,2026-01-01 08:00:00,2026-01-01 23:59:00,"
        "2026-01-02 00:01:00,10.5,1.5,TRUE,CD1",
        "s2,o1,v1,Basel,Bern,3000,IN_TRANSIT,2026-01-01 09:00:00,2026-01-02 10:00:00,,5.0,0.5,TRUE,",
        "s3,o3,v2,Bern,Basel,4000,DELIVERED,2026-01-02 09:00:00,2026-01-02 10:00:00,"
        "2026-01-05 10:00:00,5.0,0.5,FALSE,",
    ],
    "tracking_event": [
        "e1,s1,CREATED,2026-01-01 08:00:00,Basel,47.5,7.5,first",
        'e2,s1,DELIVERED,2026-01-02 00:01:00,Bern,46.9,7.4,"left ""at"" door"',
        "e3,s3,CREATED,2026-01-02 09:00:00,Bern,46.9,7.4,",
        "e4,s3,PICKED_UP,2026-01-02 09:00:00,Bern,46.9,7.4,tie",
    ],
    "merchant_account": [
        "m1,Shop A,RETAIL,R1,CH9300762011623852957,CHF,1.50,c1,TRUE,2024-01-01",
        "m2,Shop B,ECOMMERCE,R2,CH9300762011623852958,CHF,2.50,c1,TRUE,2024-01-02",
        "m3,Shop C,B2B,R3,CH9300762011623852959,EUR,0.50,c9,FALSE,2024-01-03",
    ],
    "payout": [
        "y1,m1,2026-01-01,2026-01-31,100.00,2.00,98.00,PAID,2026-02-01",
        "y2,m1,2026-02-01,2026-02-28,50.00,1.00,49.00,APPROVED,",
    ],
    "payment": [
        "x1,o1,m1,60.00,CHF,CREDIT_CARD,VISA,CAPTURED,2026-01-01,2026-01-02,TRUE,TRUE",
        "x2,o1,m1,40.00,CHF,TWINT,,CAPTURED,2026-01-01,2026-01-02,FALSE,FALSE",
        "x3,o2,m2,40.50,CHF,TWINT,,PENDING,2026-01-03,,,FALSE",
        "x4,o3,m1,60.00,CHF,TWINT,,CAPTURED,2026-01-02,2026-01-02,FALSE,TRUE",
        "x5,o9,m1,9.00,CHF,TWINT,,FAILED,2026-01-09,,FALSE,FALSE",
    ],
    "refund": [
        "r1,x1,FRAUD,5.00,REJECTED,2026-01-05,",
        "r2,x2,WRONG_ITEM,1.00,PENDING,2026-01-05,",
        "r3,x2,WRONG_ITEM,2.00,PROCESSED,2026-01-06,2026-01-07",
    ],
}


def write_seeds(folder, headers):
    for table, lines in SEED_FILES.items():
        text = "\n".join([",".join(headers(table)), *lines]) + "\n"
        (folder / f"{table}.csv").write_text(text, encoding="utf-8")
