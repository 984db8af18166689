"""Hand-typed sample landing rows (two days of orders, customers, addresses)."""

from __future__ import annotations


def _items(*xs):
    return [dict(item_id=i, name=n, category="Electronics", price=float(p), quantity=q)
            for i, n, p, q in xs]


ORDERS_DAY1 = [
    (1, 1001, "2024-10-28 04:47:27", "Credit Card", _items((10, "Drone", 799, 1)), "Pending"),
    (2, 1001, "2024-10-07 22:09:27", "Credit Card", _items((5, "Tablet", 399, 1)), "Pending"),
    (3, 1002, "2024-10-13 17:34:19", "Bank Transfer", _items((4, "Smartwatch", 299, 3)), "Unknown"),
    (4, 1003, "2024-10-20 01:47:25", "Bank Transfer", _items((9, "Smart TV", 1199, 1)), "Completed"),
    (5, 1004, "2024-10-13 12:40:26", "PayPal", _items((8, "Gaming Console", 499, 1)), "Shipped"),
    (6, 1005, "2024-10-29 21:39:19", "PayPal", _items((7, "External Hard Drive", 129, 3)), "Unknown"),
    (7, 1006, "2024-10-25 05:49:16", "Bank Transfer", _items((1, "Smartphone", 699, 1)), "Shipped"),
    (8, 1006, "2024-10-23 02:51:05", "PayPal", _items((8, "Gaming Console", 499, 1)), "Pending"),
    (9, 1007, "2024-10-06 10:23:28", "Unknown",
     _items((3, "Wireless Headphones", 199, 1), (7, "External Hard Drive", 129, 1)), "Cancelled"),
    (10, 1008, "2024-10-15 13:09:33", "Credit Card", _items((3, "Wireless Headphones", 199, 2)), "Pending"),
    (11, 1009, "2024-10-25 03:37:42", "PayPal",
     _items((10, "Drone", 799, 1), (3, "Wireless Headphones", 199, 1)), "Completed"),
    (12, 1010, "2024-10-23 20:06:42", "Bank Transfer", _items((8, "Gaming Console", 499, 2)), "Shipped"),
]
ORDERS_DAY2 = [
    (13, 1011, "2024-11-16 23:07:31", "Bank Transfer", _items((8, "Gaming Console", 499, 2)), "Cancelled"),
    (14, 1012, "2024-11-19 19:18:48", "Credit Card", _items((7, "External Hard Drive", 129, 2)), "Pending"),
    (15, 1013, "2024-11-27 13:15:29", "Bank Transfer", _items((2, "Laptop", 999, 1)), "Shipped"),
    (16, 1013, "2024-11-18 02:38:21", "PayPal", _items((5, "Tablet", 399, 2)), "Pending"),
]

CUSTOMERS_DAY1 = [
    (1001, "Richard Cox", "1996-10-25", "+1 6680703335", "richard.cox@gmail.com", "2024-10-01"),
    (1002, "Carla Morton", "2004-06-21", "+1 8616454195", None, "2024-10-01"),
    (1003, "Billy Scott", "1997-03-17", "+1 5544387564", "billy.scott@hotmail.com", "2024-10-01"),
    (1004, "Lori Mason", "2002-11-01", None, "lori.mason@yahoo.com", "2024-10-01"),
    (1005, "Jennifer Haas", "2001-04-03", "+1 4725460000", "jennifer.haas@gmail.com", "2024-10-01"),
    (1006, "Joseph Keller", "2003-02-11", "+1 3817867756", None, "2024-10-01"),
    (1007, "Jessica Harris", "2004-04-19", "+1 8604009935", None, "2024-10-01"),
    (1008, None, "2003-09-05", "+1 1448753611", "william.carter@hotmail.com", "2024-10-01"),
    (1009, "Shannon Austin", "2002-03-22", "+1 4594705629", "austin.shannon@outlook.com", "2024-10-01"),
    (1010, "Andrew Phillips", "2003-04-17", "+1 4079273853", "andrew.phillips@yahoo.com", "2024-10-01"),
]
CUSTOMERS_DAY2 = [
    (1002, "Carla Morton", "2004-06-21", "+1 8616454195", "carla.morton@yahoo.com", "2025-01-14"),
    (1004, "Lori Mason", "2002-11-01", "+1 0498301620", "lori.mason@yahoo.com", "2025-01-14"),
    (1008, "William Carter", "2003-09-05", "+1 1448753611", "william.carter@hotmail.com", "2025-01-14"),
    (1009, "Shannon Austin", "2002-03-22", "+1 4594705629", "shannon.austin@yahoo.com", "2025-01-14"),
    (1011, "Martin Thomas DDS", "2002-05-01", "+1 0201457151", "martin.dds@gmail.com", "2025-01-14"),
    (1012, "Rachel Thomas", "2003-02-17", "+1 5437271621", "rachel.thomas@gmail.com", "2025-01-14"),
    (1013, "Dr. Daniel Hall", "2004-03-21", "+1 7544137170", "dr.hall@hotmail.com", "2025-01-14"),
]

ADDRESSES_DAY1 = [
    (1001, "9713 Medina Mountains Apt. 813", "Lake Erika", "Mississippi", "91945", "2024-10-01"),
    (1002, "084 Anne Hollow Apt. 064", "East Jasontown", "Minnesota", "77329", "2024-10-01"),
    (1003, "8400 Rebecca Lodge Suite 011", "Lake Lisatown", "Montana", "11354", "2024-10-01"),
    (1004, "869 Linda Locks Apt. 105", "West Melissabury", "Michigan", "3766", "2024-10-01"),
    (1005, "4838 Jacob Neck", "Jamesview", "Wisconsin", "58657", "2024-10-01"),
    (1006, "4558 Cabrera Islands", "Lake David", None, "06133", "2024-10-01"),
    (1007, "75470 Richardson Mission Apt. 147", "New Rachelhaven", "Hawaii", "38857", "2024-10-01"),
    (1008, "4450 Michelle Mission Suite 663", "North Justin", "Kentucky", "91757", "2024-10-01"),
    (1009, "331 Monica Route Apt. 022", "Michellechester", "Texas", "14637", "2024-10-01"),
    (1010, "48794 Aguirre Ferry Apt. 952", "North Amy", "Washington", "92507", "2024-10-01"),
]
ADDRESSES_DAY2 = [
    (1001, "13677 Garcia Ports", "Shelleyland", "Rhode Island", "03719", "2025-01-14"),
    (1004, "955 Montgomery Mountain Suite 167", "Jameschester", "Kentucky", "09013", "2025-01-14"),
    (1006, "5094 Ayala Falls", "Greenmouth", "North Carolina", "02638", "2025-01-14"),
    (1011, "2856 Jeremy Wall Apt. 985", "East Elizabeth", "Oklahoma", "66460", "2025-01-14"),
    (1012, "14540 Moody Tunnel", "West Shellybury", None, "83151", "2025-01-14"),
    (1013, "5733 Richards Ferry Suite 995", "East Angelafort", "Indiana", "4623", "2025-01-14"),
]
